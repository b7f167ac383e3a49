"""Language, quality and licenses: held-out accuracy on the given tables, and small cases."""

import os
import zlib

import numpy as np
import pytest

from riskloom.llm import language, licenses, quality
from riskloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def held(key):
    return zlib.crc32(str(key).encode()) % 5 == 0


@needs_data
def test_language_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_language"](spark, SF).collect()
    assert len(rows) == len(truth) and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    own = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in own]) > 0.98


@needs_data
def test_quality_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op6_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    own = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in own]) > 0.95


def test_language_small_cases(spark, odd, none):
    model = language.fit_language(odd)
    rows = language.predict_language(odd, model, ["doc_id", "lang_pred"], names=("told", "sure")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["told"] == "und") == (r["doc_id"] in (1, 2, 3, 6, 7)) and r["lang_pred"] == "x"
        assert r["told"] in ("und", "en", "fr", "de") and 0 <= r["sure"] <= 1
    empty = language.fit_language(none)
    assert {r["lang_pred"] for r in language.predict_language(odd, empty, ["doc_id"]).collect()} == {"und"}
    assert language.predict_language(none, model, ["doc_id"]).count() == 0
    again = language.predict_language(odd.repartition(3), language.fit_language(odd.repartition(5)), ["doc_id"])
    key = lambda r: (r[0] or -1, r[1])
    assert sorted(((r[0], r[2], r[3]) for r in rows), key=key) == sorted((tuple(r) for r in again.collect()), key=key)


def test_families_come_first():
    model = language.LanguageModel(["en", "de", "fr", "xx"], {})
    assert model.families == ["germanic", "only xx", "romance"] and model.pairs == [("germanic", "de", "en")]


def test_leader_learns_a_separable_problem():
    rng = np.random.default_rng(1)
    leader = quality.Leader()
    data = [(quality.features("good fine nice " * 3 + f"n{rng.integers(99)}"), 1) for _ in range(60)]
    data += [(quality.features("bad poor ugly " * 3 + f"n{rng.integers(99)}"), 0) for _ in range(60)]
    for _ in range(3):
        for i in rng.permutation(len(data)):
            leader.step(*data[i][0], data[i][1])
    model = quality.QualityModel(*leader.weights())
    assert model.score("good nice fine") > 0.8 and model.score("ugly bad") < 0.2
    assert quality.shape("thouhe$$$") == "a$$$" and quality.shape("THE!!") == "A!!" and quality.shape("a1-B2") == "a-A"


def test_score_is_the_dot_product_of_features():
    w = np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32)
    model = quality.QualityModel(w, 0.1)
    for text in ("a b c a b", "One!", "x " * 500):
        at, x = quality.features(text)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-(w[at].astype(float) @ x + 0.1))), rel=1e-6)


def test_quality_small_cases(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (8, 0), (None, 1), (99, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit_quality(odd, labels)
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3, 6)}) == 1
    assert quality.score_quality(none, model).count() == 0
    assert {r["score"] for r in quality.score_quality(odd, quality.fit_quality(none, labels)).collect()} == {0.5}
    assert {r["score"] for r in quality.score_quality(odd, quality.fit_quality(odd, labels.limit(0))).collect()} == {0.5}


def expand(markup):
    """All word sequences of a template without replaceable regions."""
    out, parts = [[]], markup.split()
    i = 0
    while i < len(parts):
        if parts[i] == "<<optional>>":
            end = parts.index("<<end>>", i)
            inside = parts[i + 1:end]
            out = [o + tail for o in out for tail in ([], inside)]
            i = end
        else:
            out = [o + [parts[i]] for o in out]
        i += 1
    return {tuple(o) for o in out}


def test_automaton_accepts_exactly_the_template():
    import random
    rng = random.Random(6)
    markup = "<<optional>> a <<end>> b <<optional>> c d <<end>> e <<optional>> f <<end>>"
    automaton, words = licenses.Automaton(markup), "a b c d e f x".split()
    accepted = expand(markup)
    for _ in range(3000):
        text = [rng.choice(words).encode() for _ in range(rng.randrange(1, 8))]
        want = max([n for n in range(1, len(text) + 1) if tuple(w.decode() for w in text[:n]) in accepted], default=-1)
        assert automaton.match(text, 0) == want
    any_two = licenses.Automaton("x <<var:2>> y")
    assert [any_two.match(t.encode().split(), 0) for t in ("x y", "x q y", "x q q y", "x q q q y", "x z")] == [2, 3, 4, -1, -1]
    with pytest.raises(ValueError):
        licenses.Automaton("<<optional>> a <<end>>")


def test_base_places_like_plain_search(spark):
    texts = {1: "Released under the MIT-License. UNDER THE MIT license!", 2: "Apache License, Version 2.0", 3: "cc BY nc by NC cc by nc", 4: None,
             5: "under the mité license", 6: "", 7: "Licensed under CC BY-NC 4.0."}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in licenses.scan_licenses(df).collect():
        words = []
        for c in (texts[r["doc_id"]] or ""):
            words.append(c.lower() if c.isascii() else c) if c.isascii() and c.isalnum() or not c.isascii() else words.append(" ")
        words = "".join(words).split()
        want = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
        assert r["n_words"] == len(words) and [(p["first"], p["label"]) for p in r["phrases"]] == want
    found = {r["doc_id"]: [m["label"] for m in r["matches"]] for r in licenses.scan_licenses(df).collect()}
    assert found[7] == ["cc-by-nc-notice"] and found[1] == ["mit-notice", "mit-notice"] and found[5] == []


def test_license_small_cases(spark, odd, none):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == odd.count() and all(r["phrases"] == [] and r["share"] == 0 for r in rows)
    assert licenses.scan_licenses(none).count() == 0


def test_samples_of_huge_tables_are_not_empty(spark):
    """A share far below one in a million still draws about as many rows as it says."""
    from riskloom.llm.texts import drawn

    ids = spark.range(200_000)
    assert 60 < ids.filter(drawn(100 / 200_000, "id")).count() < 150
    assert ids.filter(drawn(1.0, "id")).count() == 200_000 and ids.filter(drawn(0.5, "id")).count() < 101_500
    # The threshold of a share of 1e-15 is not the smallest number.
    assert int(1e-15 * 2**64) > 18_000


def test_copies_are_drawn_one_by_one(spark):
    from pyspark.sql import functions as F
    from riskloom.llm import language

    copies = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang"))
    others = spark.range(400).select((F.col("id") + 10_000).alias("doc_id"), F.concat(F.lit("ein text "), "id").alias("text"), F.lit("de").alias("lang"))
    seen = []
    real = language.drawn
    language.drawn = lambda share, *c: seen.append(share) or real(share, *c)
    try:
        model = language.fit_language(copies.unionByName(others).unionByName(copies.limit(1)), per_language=200)
    finally:
        language.drawn = real
    assert sorted(round(s, 3) for s in seen) == [0.05, 0.5] and model.predict("the same text")[0] == "en"


def test_predictions_equal_a_loop_over_the_machines(spark):
    """Every machine scored by itself, families first, then the votes of the pairs within the winner."""
    import random

    import numpy as np
    from riskloom.llm import language

    rng = random.Random(3)
    alphabets = {"en": "etaoin", "de": "enisrü", "fr": "esaité", "es": "eaosñr", "ru": "оеаинт"}
    rows = [(i, code, " ".join("".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(rng.randrange(1, 30))))
            for i, (code, letters) in enumerate(list(alphabets.items()) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.fit_language(docs, per_language=40)
    names = [f"family {f}" for f in model.families] + [f"pair {a} {b}" for _, a, b in model.pairs]
    machine = dict(zip(names, model.weights))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_language(docs, model, ["doc_id"]).collect()}
    for key, _, text in rows:
        x = language.ngram_counts(text)
        margins = {f: float(machine[f"family {f}"] @ x) for f in model.families}
        family = max(sorted(margins), key=margins.get)
        members = [c for c in alphabets if language.FAMILY_OF[c] == family]
        wins = {c: [0, 0.0] for c in members}
        for a in members:
            for b in members:
                if a < b:
                    m = float(machine[f"pair {a} {b}"] @ x)
                    for c, own in ((a, m), (b, -m)):
                        wins[c][0] += own > 0
                        wins[c][1] += own
        best = max(sorted(wins), key=lambda c: tuple(wins[c]))
        # Sums of products differ in their last bits between one matrix and single rows.
        close = min(abs(v) for v in margins.values()) < 1e-6 or any(abs(w[1]) < 1e-6 for w in wins.values()) and len(wins) > 1
        assert got[key][0] == best or close
        assert 0 <= got[key][1] <= 1 and np.isfinite(got[key][1])


@pytest.mark.parametrize("label, text", [
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
     "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
     "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR "
     "OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd-3-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary "
     "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
     "with the distribution.\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
     "this software without specific prior written permission."),
    ("apache-2-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
     "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("gpl-3-header", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("lgpl-2-header", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mpl-2-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
     "You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by-sa-4", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
])
def test_license_wordings(spark, label, text):
    broken = text.split()
    broken[len(broken) // 2:len(broken) // 2] = ["never", "ever", "otherwise", "quite", "so", "many", "words", "here", "and", "there", "too", "now", "again", "then"]
    rows = [(1, "Before it. " + text + " And after."), (2, " ".join(broken))]
    got = {r["doc_id"]: {m["label"] for m in r["matches"]} for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert label in got[1] and label not in got[2]


def test_products_of_long_int8_vectors_are_exact():
    import numpy as np
    from riskloom.llm.neighbours import Quantised

    rng = np.random.default_rng(2)
    q, b = (Quantised(rng.choice([-1.0, 1.0, 0.98], (20, 5000))) for _ in range(2))
    near, off = q.bounds(b, slice(0, 20), slice(0, 20))
    whole = q.rows.astype(np.int64) @ b.rows.astype(np.int64).T
    assert np.array_equal(near, whole * (q.scale[:, None] * b.scale[None, :]))
    true = (q.raw / q.norm[:, None]) @ (b.raw / b.norm[:, None]).T
    assert (np.abs(near - true) <= off).all()
