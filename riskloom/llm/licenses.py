"""License scans by template matching: license wording as templates with optional and replaceable regions.

A template is compiled into an automaton over words. Plain words are mandatory and must match exactly and in order; words between
``<<optional>>`` and ``<<end>>`` may be missing as a whole; ``<<var:n>>`` stands for up to n words of any kind. The automaton runs
from each place where a template can begin, in texts that hold the template's rarest mandatory word, and the longest match counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from riskloom.llm.texts import in_chunks, map_documents

#: Words are runs of ASCII letters and digits (letters in lower case) and of all characters beyond ASCII.
_KEEP = bytes(b if b >= 128 or chr(b).isdigit() or "a" <= chr(b) <= "z" else 32 for b in range(256))

#: Phrases that name a license, and its label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label and wording of license notices and texts, with their optional and replaceable regions.
TEMPLATES = (
    ("mit-notice", "<<optional>> released <<end>> <<optional>> licensed <<end>> under the <<optional>> terms of the <<end>> mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights to use "
     "copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software "
     "is furnished to do so subject to the following conditions <<var:3>> the above copyright notice and this permission notice "
     "<<optional>> including the next paragraph <<end>> shall be included in all copies or substantial portions of the software"),
    ("apache-2-notice", "licensed under the apache license version 2 <<optional>> 0 <<end>> <<optional>> the license <<end>>"),
    ("cc-by-nc-notice", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> cc by nc <<optional>> sa <<end>> "
     "<<optional>> nd <<end>> <<var:2>>"),
    ("gpl-3-notice", "licensed under the gnu <<optional>> lesser <<end>> <<optional>> affero <<end>> general public license "
     "<<optional>> as published by the free software foundation <<end>> <<optional>> either <<end>> version 3 "
     "<<optional>> or any later version <<end>>"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("rights-reserved", "<<optional>> copyright <<var:6>> <<end>> all rights reserved"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the "
     "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
     "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of "
     "or in connection with the software or the use or other dealings in the software"),
    ("isc-text", "permission to use copy modify and <<optional>> or <<end>> distribute this software for any purpose with or without fee "
     "is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is "
     "provided as is and <<var:8>> disclaims all warranties with regard to this software including all implied warranties of "
     "merchantability and fitness in no event shall <<var:8>> be liable for any special direct indirect or consequential damages or any "
     "damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action "
     "arising out of or in connection with the use or performance of this software"),
    ("bsd-2-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met <<var:1>> redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer <<var:1>> redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met <<var:1>> redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer <<var:1>> redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
     "<<var:1>> neither the name of <<var:12>> nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission"),
    ("apache-2-header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at <<var:8>> unless required by applicable law or agreed to in writing software "
     "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or "
     "implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-2-header", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3-header", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2-header", "you can redistribute it and or modify it under the terms of the gnu <<optional>> library <<end>> <<optional>> "
     "lesser <<end>> general public license as published by the free software foundation either version 2 1 of the license or at your "
     "option any later version"),
    ("lgpl-3-header", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
     "the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3-header", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
     "the free software foundation either version 3 of the license or at your option any later version"),
    ("mpl-2-header", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at"),
    ("cc-by-4", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> creative commons attribution 4 0 international license"),
    ("cc-by-sa-4", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> creative commons attribution sharealike 4 0 "
     "international license"),
    ("cc-by-nd-4", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> creative commons attribution noderivatives 4 0 "
     "international license"),
    ("cc-by-nc-4", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> creative commons attribution noncommercial "
     "<<optional>> sharealike <<end>> <<optional>> noderivatives <<end>> 4 0 international license"),
    ("cc0-1", "to the extent possible under law <<var:12>> waived all copyright and related or neighboring rights to"),
    ("unlicense-text", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
     "use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non "
     "commercial and by any means"),
    ("zlib-text", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose "
     "including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("boost-text", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the "
     "software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so"),
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_KEEP).split()


class Automaton:
    """Words of a template as states. State i moves to i + 1 by its word; optional and replaceable regions add ways around."""

    def __init__(self, markup: str):
        self.word: list[bytes | None] = []  # None: any word
        self.skip: dict[int, list[int]] = {}
        opened: list[int] = []
        must: list[bytes] = []
        for part in markup.split():
            at = len(self.word)
            if part == "<<optional>>":
                opened.append(at)
            elif part == "<<end>>":
                self.skip.setdefault(opened.pop(), []).append(at)
            elif m := re.fullmatch(r"<<var:(\d+)>>", part):
                for i in range(int(m[1])):  # each of the n words may be the first that is missing
                    self.skip.setdefault(at + i, []).append(at + int(m[1]))
                    self.word.append(None)
            else:
                self.word.append(part.encode())
                if not opened:
                    must.append(part.encode())
        if opened or not must:
            raise ValueError(f"open region, or nothing mandatory: {markup}")
        self.final = len(self.word)
        #: The longest mandatory word: where it is missing, nothing can match.
        self.anchor = max(must, key=len)
        self.starts = self._closed({0})
        self.first = {self.word[s] for s in self.starts if s < self.final}

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip.get(todo.pop(), ()):
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def match(self, words: list[bytes], at: int) -> int:
        """End of the longest match that starts at word ``at``, or -1."""
        states, end = self.starts, -1
        for i in range(at, len(words) + 1):
            if self.final in states:
                end = i
            if i == len(words):
                break
            states = self._closed({s + 1 for s in states if s < self.final and self.word[s] in (None, words[i])})
            if not states:
                break
        return end


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: tuple = TEMPLATES):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.templates = [(label, Automaton(markup)) for label, markup in templates]

    def phrase_places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(first word, label) of all places of all phrases."""
        line, out = b" " + b" ".join(words) + b" ", []
        for phrase, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                out.append((line.count(b" ", 0, at + 1) - 1, label))
                at = line.find(phrase, at + 1)
        return sorted(out)

    def template_spans(self, words: list[bytes]) -> list[tuple[int, int, str]]:
        """(first word, end, label): the longest match from each start, without those inside a match of the same template."""
        out, present = [], set(words)
        for label, automaton in self.templates:
            if automaton.anchor not in present:
                continue
            after = 0
            anywhere = None in automaton.first
            for i, word in enumerate(words):
                if i >= after and (anywhere or word in automaton.first) and (end := automaton.match(words, i)) > i:
                    out.append((i, end, label))
                    after = end
        return sorted(out)

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        places, spans = self.phrase_places(words), self.template_spans(words)
        covered, reach = 0, 0
        for start, end, _ in spans:
            covered += max(0, end - max(start, reach))
            reach = max(reach, end)
        return {"n_words": len(words), "places": places, "spans": spans, "share": covered / len(words) if words else 0.0}


def scan_licenses(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, repeated rows included; a null text counts as empty.

    Returns ``id_col``, n_words, phrases array<struct<first, label>> (every place of a phrase, by place), matches
    array<struct<first, end, label>> (template matches, end exclusive) and share, the share of words inside template matches.
    A text without words has no places and the share 0.
    """
    own = scanner or Scanner()
    schema = (f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, phrases array<struct<first:long,label:string>>, "
              "matches array<struct<first:long,end:long,label:string>>, share double")

    def scan(rows: Iterator[tuple]):
        for part in in_chunks(rows, 1):
            found = [own.scan(t) for _, t in part]
            yield {
                id_col: [r[0] for r in part], "n_words": [f["n_words"] for f in found], "share": [f["share"] for f in found],
                "phrases": [[{"first": a, "label": b} for a, b in f["places"]] for f in found],
                "matches": [[{"first": a, "end": b, "label": c} for a, b, c in f["spans"]] for f in found],
            }

    return map_documents(docs, [id_col, text_col], schema, scan)
