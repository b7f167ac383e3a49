"""Language identification in two steps: the language family first, then the closely related languages within it.

Every step is a linear support vector machine over hashed byte n-grams: one against the rest between families, one against one
within a family, where each pair of languages votes. A machine is trained in a Spark task of its own from a bounded sample of the
labelled rows; scoring is a map over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import Shipped, drawn, map_documents

#: Language families by ISO code. A language outside the table is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lv", "lt"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
    "sinitic": ("zh", "yue"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

BUCKETS = 1 << 14
EPOCHS, PENALTY = 4, 1e-4
UNKNOWN = "und"

# Lower case for ASCII; everything in ASCII that is no letter becomes a blank.
_FOLD = bytes(b if b >= 128 else (b | 32 if chr(b).isalpha() else 32) for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte bigrams and trigrams, scaled to length 1."""
    b = np.frombuffer((" " + text.lower() + " ").encode().translate(_FOLD), np.uint8).astype(np.uint32)
    two = b[:-1] << 8 | b[1:]
    three = two[:-1] << 8 | b[2:]
    keep = ~((b[:-2] == 32) & (b[1:-1] == 32))  # runs of blanks say nothing
    ids = np.concatenate([two[:-1][keep] * np.uint32(0x9E3779B1) >> 18, three[keep] * np.uint32(0x85EBCA6B) >> 18])
    counts = np.sqrt(np.bincount(ids, minlength=BUCKETS)).astype(np.float32)
    return counts / max(1e-9, float(np.linalg.norm(counts)))


def train_svm(features: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, seed: int = 7) -> np.ndarray:
    """Weights of a linear SVM by averaged stochastic subgradient steps on the hinge loss; features are (index, value) pairs."""
    w, total, scale, step = np.zeros(BUCKETS), np.zeros(BUCKETS), 1.0, 0
    order = np.random.default_rng(seed)
    # Both sides weigh the same, however many rows they have.
    share = {s: len(signs) / (2 * max(1, int((signs == s).sum()))) for s in (-1, 1)}
    for epoch in range(EPOCHS):
        for i in order.permutation(len(features)):
            step += 1
            rate = 1 / (PENALTY * (step + 1 / PENALTY))
            scale *= 1 - rate * PENALTY
            at, x = features[i]
            if signs[i] * scale * float(w[at] @ x) < 1:
                w[at] += rate * share[int(signs[i])] * signs[i] * x / scale
        total += w * scale
    return (total / EPOCHS).astype(np.float32)


class LanguageModel:
    """Trained machines: ``families`` (one row of weights each) and ``pairs`` of languages within a family."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray]):
        self.members: dict[str, list[str]] = {}
        for code in sorted(languages):
            self.members.setdefault(FAMILY_OF.get(code, f"only {code}"), []).append(code)
        self.families = sorted(self.members)
        names = [f"family {f}" for f in self.families] if len(self.families) > 1 else []
        self.pairs = [(f, a, b) for f in self.families for a, b in combinations(self.members[f], 2)]
        names += [f"pair {a} {b}" for _, a, b in self.pairs]
        empty = np.zeros(BUCKETS, np.float32)
        self.weights = np.stack([weights.get(n, empty) for n in names]) if names else np.zeros((0, BUCKETS), np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or text is None or not has_letter(text):
            return UNKNOWN, 0.0
        margin = self.weights @ ngram_counts(text)
        sure = lambda m: 1 / (1 + np.exp(-4 * float(m)))
        family, score, many = self.families[0], 1.0, len(self.families)
        if many > 1:
            best = int(np.argmax(margin[:many]))
            family, score = self.families[best], sure(margin[best])
        offset = many if many > 1 else 0
        votes = {code: [0, 0.0, []] for code in self.members[family]}
        for k, (f, a, b) in enumerate(self.pairs):
            if f == family:
                m = float(margin[offset + k])
                for code, own in ((a, m), (b, -m)):
                    votes[code][0] += own > 0
                    votes[code][1] += own
                    votes[code][2].append(own)
        code = max(sorted(votes), key=lambda c: (votes[c][0], votes[c][1]))
        return code, float(score * (sure(min(votes[code][2])) if votes[code][2] else 1.0))


def _machines(languages: list[str]) -> list[tuple[str, dict[str, int]]]:
    """Name of every machine, and the sign that each language has in it."""
    family = {c: FAMILY_OF.get(c, f"only {c}") for c in languages}
    every = sorted(set(family.values()))
    out = [(f"family {f}", {c: 1 if family[c] == f else -1 for c in languages}) for f in every] if len(every) > 1 else []
    return out + [(f"pair {a} {b}", {a: 1, b: -1}) for a, b in combinations(sorted(languages), 2) if family[a] == family[b]]


def fit_language(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = 1200,
                 id_col: str = "doc_id") -> LanguageModel:
    """Train on about ``per_language`` rows of each language, drawn by a hash of id and text (all, if there are fewer).

    Rows without language or text are left out, and rows that repeat id and text count once. Copies with other ids are drawn each by
    itself, so no group of them comes as a whole. The bound is on training alone. No rows: a model that answers ``und``.
    """
    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}  # one row for each language
    machines = _machines(list(sizes))
    if not machines:
        return LanguageModel(list(sizes), {})
    chosen = F.lit(False)
    for code, n in sizes.items():
        chosen = F.when(F.col("lang") == code, drawn(per_language / n, "key", "text", F.lit("language"))).otherwise(chosen)
    roles = [(name, code, sign) for name, signs in machines for code, sign in signs.items()]
    pick = F.array(*[F.struct(F.lit(n).alias("machine"), F.lit(c).alias("code"), F.lit(s).alias("sign")) for n, c, s in roles])
    rows = (known.filter(chosen).dropDuplicates(["key", "lang", "text"])
            .select(F.col("lang").alias("own"), "text", F.explode(pick).alias("role"))
            .filter("role.code = own").select("role.machine", "role.sign", "text"))

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["sign", "text"])
        features = []
        for text in part["text"]:
            counts = ngram_counts(text)
            at = np.flatnonzero(counts)
            features.append((at, counts[at].astype(np.float64)))
        w = train_svm(features, part["sign"].to_numpy())
        return pd.DataFrame({"machine": [part["machine"].iloc[0]], "weights": [w.astype("<f4").tobytes()]})

    trained = rows.groupBy("machine").applyInPandas(train, "machine string, weights binary").collect()  # one row a machine
    return LanguageModel(list(sizes), {r[0]: np.frombuffer(r[1], "<f4") for r in trained})


def predict_language(docs: DataFrame, model: LanguageModel, columns: list[str], text_col: str = "text",
                     names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred string and score double, or under other ``names``.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned. Repeated rows stay.
    """
    shared = Shipped(docs.sparkSession, model)  # a row of weights for each machine, whatever the corpus is
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns) + f", {names[0]} string, {names[1]} double"

    def predict(rows: Iterator[tuple]):
        own = shared.value
        held: dict[str, list] = {}
        for row in rows:
            code, score = own.predict(row[-1])
            for name, value in zip((*columns, *names), (*row[:-1], code, score)):
                held.setdefault(name, []).append(value)
            if len(held[names[1]]) >= 256:
                yield held
                held = {}
        if held:
            yield held

    return map_documents(docs, [*columns, text_col], schema, predict)
