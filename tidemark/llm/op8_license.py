"""License scans by template markup.

A template is wording with markup: <<optional>> ... <<end>> may be missing, <<var N>> stands for up to N words of any
kind. It is compiled into an automaton over word hashes; a place in a text is accepted if the mandatory words match
exactly, in order, with nothing between them but optional and replaceable regions. Whole Arrow batches are turned into
words at once, and an automaton runs only where its rarest mandatory word stands.

Null or empty text has no words, labels "" and score 0. Repeated rows get equal results. Very long texts take memory in
proportion to their length. Empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from .common import Batch, parts, prefix_hash, span_hash

#: The base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Wording of public licences and notices, whole where a licence is short, else the notice that it asks for; the third item
#: is a mandatory word, whose places are tried.
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders <<optional>> x consortium <<end>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
_BSD_OPEN = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<optional>> 1 <<end>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<optional>> 2 <<end>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_THIRD = "<<optional>> 3 <<end>> neither the name of <<var 12>> nor the names of <<optional>> its <<end>> <<optional>> their <<end>> contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_END = "this software is provided by <<var 12>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var 12>> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_GNU = "free software you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation <<optional>> either version <<var 2>> of the license or <<optional>> at your option <<end>> any later version <<end>>"
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<optional>> including the next paragraph <<end>> shall be included in all copies or substantial portions of the software " + _AS_IS, "sublicense"),
    ("isc", "permission to use copy modify and <<optional>> or <<end>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and <<var 6>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<var 6>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software", "fee"),
    ("bsd-3", f"{_BSD_OPEN} {_BSD_THIRD} {_BSD_END}", "redistributions"),
    ("bsd-2", f"{_BSD_OPEN} {_BSD_END}", "redistributions"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions <<optional>> 1 <<end>> the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required <<optional>> 2 <<end>> altered source versions must be plainly marked as such and must not be misrepresented as being the original software <<optional>> 3 <<end>> this notice may not be removed or altered from any source distribution", "commercial"),
    ("apache-2", "licensed under the apache license version 2 0 <<optional>> the license <<end>> you may not use this <<var 3>> except in compliance with the license you may obtain a copy of the license at <<optional>> http <<optional>> s <<end>> <<end>> <<optional>> https <<end>> <<optional>> www <<end>> apache org licenses license 2 0 <<optional>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license <<end>>", "apache"),
    ("gpl", _GNU.format("general public license"), "redistribute"),
    ("lgpl", _GNU.format("lesser general public license"), "redistribute"),
    ("agpl", _GNU.format("affero general public license"), "redistribute"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at <<optional>> http <<end>> <<optional>> https <<end>> <<optional>> www <<end>> mozilla org mpl 2 0", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", "unencumbered"),
    ("apache-2", "spdx license identifier apache 2 0", "spdx"),
    ("mit", "spdx license identifier mit", "spdx"),
    # openings and notices that name a licence without its wording
    ("mit-opening", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby"),
    ("bsd-opening", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("apache-2-notice", "licensed under the apache license version 2 0", "apache"),
    ("mit-notice", "<<optional>> is <<end>> <<optional>> released <<end>> <<optional>> licensed <<end>> <<optional>> distributed <<end>> under the mit license", "mit"),
    ("cc-by-nc", "creative commons attribution non commercial <<var 4>> license", "commons"),
    ("cc-by-nc", "creative commons attribution noncommercial <<var 4>> license", "noncommercial"),
    ("copyright", "copyright <<optional>> c <<end>> <<var 8>> all rights reserved", "copyright"),
]

_GAP = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


def hash_words(words: list[str]) -> np.ndarray:
    data = "".join(words).encode()
    sizes = np.array([len(w.encode()) for w in words], dtype=np.int64)
    ends = np.cumsum(sizes)
    return span_hash(prefix_hash(np.frombuffer(data, np.uint8)), ends - sizes, ends)


@dataclass
class Automaton:
    """States 0..accept. steps[s]: (word hash, next); skip[s]: states reached without a word; gap[s]: words that s may swallow."""

    label: str
    mandatory: int
    steps: dict[int, tuple[int, int]] = field(default_factory=dict)
    skip: dict[int, list[int]] = field(default_factory=dict)
    gap: dict[int, int] = field(default_factory=dict)
    accept: int = 0
    anchor: int = 0
    reach: int = 0  # most words that can come before the anchor

    def run(self, words: np.ndarray, at: int, end: int) -> int:
        """The end of the shortest accepted run of words[at:end] that starts at at, or -1."""
        live = self._closed({0: 0})
        while True:
            if self.accept in live:
                return at
            if at >= end or not live:
                return -1
            word, now = int(words[at]), {}
            for s, used in live.items():
                step = self.steps.get(s)
                if step and step[0] == word:
                    now[step[1]] = 0
                if used < self.gap.get(s, 0):
                    now[s] = min(now.get(s, used + 1), used + 1)
            live, at = self._closed(now), at + 1

    def _closed(self, live: dict[int, int]) -> dict[int, int]:
        todo = list(live)
        while todo:
            for t in self.skip.get(todo.pop(), ()):
                if t not in live:
                    live[t] = 0
                    todo.append(t)
        return live


def compile_template(label: str, markup: str, anchor: str) -> Automaton:
    """The automaton of a template; optional regions may hold others. ValueError if they don't pair up."""
    a, state, opened, before = Automaton(label, 0), 0, [], 0
    for token in re.findall(r"<<[^>]*>>|\S+", markup):
        if token == "<<optional>>":
            opened.append(state)
        elif token == "<<end>>":
            if not opened:
                raise ValueError(f"{label}: <<end>> without <<optional>>")
            a.skip.setdefault(opened.pop(), []).append(state)
        elif token.startswith("<<var"):
            # a state of its own: a region that is left out must not swallow its words
            a.skip.setdefault(state, []).append(state + 1)
            a.gap[state + 1] = int(token[5:-2])
            before += a.gap[state + 1]
            a.skip.setdefault(state + 1, []).append(state + 2)
            state += 2
        else:
            if token == anchor and not opened and not a.anchor:
                a.anchor, a.reach = int(hash_words([token])[0]), before
            a.steps[state] = (int(hash_words([token])[0]), state + 1)
            a.mandatory += not opened
            before += 1
            state += 1
    if opened:
        raise ValueError(f"{label}: <<optional>> without <<end>>")
    if not a.anchor:
        raise ValueError(f"{label}: {anchor} is no mandatory word")
    a.accept = state
    return a


def scan(docs: DataFrame, templates=None, phrases=None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of docs.

    score: the largest share of mandatory words among the words of an accepted place; a base phrase is all mandatory.
    """
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        automata = [compile_template(*t) for t in templates]
        exact = [(hash_words(p.split()), label) for p, label in phrases.items()]
        for b in batches:
            yield from (scan_batch(pa, part, automata, exact) for part in parts(b))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan_batch(pa, b, automata, exact):
    texts = Batch(b.column("text"))
    starts, ends, bounds = texts.words(_GAP)
    words = span_hash(prefix_hash(texts.data), starts, ends)
    n = b.num_rows
    doc = lambda at: int(np.searchsorted(bounds, at, side="right")) - 1
    n_base = np.zeros(n, np.int64)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    base, labels, score = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
    for phrase, label in exact:
        at = np.flatnonzero(words[: max(0, len(words) - len(phrase) + 1)] == phrase[0])
        for k in range(1, len(phrase)):
            at = at[words[at + k] == phrase[k]]
        for x in at.tolist():
            i = doc(x)
            if x + len(phrase) <= bounds[i + 1]:
                place = x - int(bounds[i])
                n_base[i] += 1
                first[i] = place if first[i] < 0 else min(first[i], place)
                last[i] = max(last[i], place)
                base[i].add(label)
                labels[i].add(label)
                score[i] = 1.0
    for a in automata:
        for x in np.flatnonzero(words == np.uint64(a.anchor)).tolist():
            i = doc(x)
            for at in range(x, max(int(bounds[i]), x - a.reach) - 1, -1):
                end = a.run(words, at, int(bounds[i + 1]))
                if end > x:
                    labels[i].add(a.label)
                    score[i] = max(score[i], min(1.0, a.mandatory / (end - at)))
                    break
    place = lambda v: pa.array([None if x < 0 else x for x in v.tolist()], pa.int64())
    text = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), pa.array(np.diff(bounds)), pa.array(n_base), place(first), place(last), text(base), text(labels), pa.array(score)],
        ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    )
