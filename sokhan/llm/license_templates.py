"""License scan: template markup compiled into token automata.

A template is mandatory words with two kinds of markup:

* ``<<beginOptional>> ... <<endOptional>>``: the words inside may be missing;
* ``<<var;max=N>>``: any words, at most N; ``<<var;match=a|b|c>>``: one of these.

Compiling gives a nondeterministic automaton over words. A text matches if some
run of its words takes the automaton from start to end, so all mandatory wording
stands there exactly and in order; case, punctuation and line breaks don't count.
Templates whose longest mandatory wording is missing are not run.

There are two sorts of templates, by label. A license's name alone (``mit``, ``bsd-2-clause``,
``bsd-3-clause``, ``isc``, ``zlib``, ``unlicense``) means that its whole text stands there, each
mandatory word of it; ``...-header`` is the whole standard header of a longer license;
``...-notice`` is a sentence that names a license. A text that begins like a license and goes
on otherwise gets none of its labels.

Fixed phrases (``PHRASES``) are counted besides and give labels of their own.
Null and empty texts have no words and no labels, an empty table gives no rows. Repeated rows
are scanned alike. Only the id and the text are read, so other columns can't clash; the result
has none of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sokhan.llm.common import by_batch, id_and_text, table, utf8

# Fixed values of the contract.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
_WARRANTY = "implied warranties of merchantability and fitness for a particular purpose"
_BSD_HEAD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<beginOptional>> <<var;match=1|a>> <<endOptional>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<beginOptional>> <<var;match=2|b>> <<endOptional>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_THIRD = "<<beginOptional>> <<var;match=3|c>> <<endOptional>> neither the name of <<var;max=20>> nor the names of <<var;max=4>> contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_TAIL = f"this software is provided by <<var;max=20>> as is and any express or implied warranties including but not limited to the {_WARRANTY} are disclaimed in no event shall <<var;max=20>> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_GNU = "this <<var;max=4>> is free software you can redistribute it and or modify it under the terms of the gnu {name} general public license as published by the free software foundation either version <<var;match=1|2|3>> <<beginOptional>> 1 <<endOptional>> <<beginOptional>> 0 <<endOptional>> of the license or at your option any later version <<beginOptional>> this <<var;max=4>> is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {name} general public license for more details <<endOptional>>"
#: Words of public licenses, their headers and notices, with their optional and replaceable regions.
TEMPLATES = {
    "agpl-header": _GNU.format(name="affero"),
    "apache-2-header": "licensed under the apache license version 2 0 the license you may not use this <<var;match=file|software|work>> except in compliance with the license you may obtain a copy of the license at <<var;max=8>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "apache-2-notice": "licensed under the apache license <<beginOptional>> version <<endOptional>> 2 0",
    "bsd-2-clause": f"{_BSD_HEAD} {_BSD_TAIL}",
    "bsd-3-clause": f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}",
    "cc-by-nc-notice": "licensed under <<beginOptional>> a <<endOptional>> cc by nc <<beginOptional>> <<var;match=sa|nd>> <<endOptional>> <<var;match=2|3|4>> 0",
    "cc-by-notice": "licensed under <<beginOptional>> a <<endOptional>> cc by <<beginOptional>> <<var;match=sa|nd>> <<endOptional>> <<var;match=2|3|4>> 0",
    "copyright-notice": "copyright <<beginOptional>> c <<endOptional>> <<var;max=8>> all rights reserved",
    "gpl-header": _GNU.replace("{name} ", ""),
    "gpl-notice": "<<beginOptional>> this <<var;max=3>> is <<endOptional>> licensed under the gnu general public license <<beginOptional>> as published by the free software foundation <<endOptional>> <<beginOptional>> either <<endOptional>> version <<var;match=1|2|3>>",
    "isc": "permission to use copy modify and <<beginOptional>> or <<endOptional>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and <<var;max=6>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<var;max=8>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "lgpl-header": _GNU.format(name="<<var;match=lesser|library>>"),
    "mit": f"permission is hereby granted free of charge to any person obtaining a copy of this software and <<beginOptional>> of <<endOptional>> associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<beginOptional>> including the next paragraph <<endOptional>> shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<var;max=8>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit-notice": "<<var;match=released|licensed|distributed|available>> under the <<beginOptional>> terms of the <<endOptional>> mit license",
    "mpl-2-header": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at <<var;max=8>>",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "zlib": "this software is provided as is without any express or implied warranty in no event will <<var;max=8>> be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution",
}
FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass
class Automaton:
    """States are numbers; from each, words (None: any) and free steps lead on."""

    words: dict[int, list[tuple[bytes | None, int]]] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)
    end: int = 0
    anchor: bytes = b""

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.free.get(todo.pop(), ()):
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return out

    def first(self) -> set[bytes | None]:
        return {w for s in self.closure({0}) for w, _ in self.words.get(s, ())}

    def match(self, text: list[bytes], at: int) -> int | None:
        """The end of the shortest accepted run of words from a place."""
        states = self.closure({0})
        for i in range(at, len(text) + 1):
            if self.end in states:
                return i
            if i == len(text):
                return None
            word = text[i]
            states = self.closure({t for s in states for w, t in self.words.get(s, ()) if w is None or w == word})
            if not states:
                return None
        return None

    def find(self, text: list[bytes], joined: bytes) -> list[tuple[int, int]]:
        """Places of accepted runs, leftmost first, none overlapping."""
        if b" " + self.anchor + b" " not in joined:
            return []
        first, out, free = self.first(), [], 0
        for i, w in enumerate(text):
            if i >= free and (w in first or None in first) and (end := self.match(text, i)) is not None:
                out.append((i, end))
                free = end
        return out


def compile_template(markup: str) -> Automaton:
    """An automaton from markup; ValueError if regions don't nest or nothing is mandatory."""
    made, state, opened, run, runs = Automaton(), 0, [], [], []
    for token in re.findall(r"<<.*?>>|[^\s<]+", markup):
        if token == "<<beginOptional>>":
            opened.append(state)
        elif token == "<<endOptional>>":
            made.free.setdefault(opened.pop(), []).append(state)
        elif m := re.fullmatch(r"<<var;max=(\d+)>>", token):
            last = state + int(m[1])
            for s in range(state, last):
                made.words.setdefault(s, []).append((None, s + 1))
                made.free.setdefault(s, []).append(last)
            state = last
        elif m := re.fullmatch(r"<<var;match=([^>]+)>>", token):
            made.words.setdefault(state, []).extend((w.encode(), state + 1) for w in m[1].split("|"))
            state += 1
        elif token.startswith("<<"):
            raise ValueError(f"unknown markup {token}")
        else:
            made.words.setdefault(state, []).append((token.encode(), state + 1))
            state += 1
            if not opened:
                run.append(token.encode())
                continue
        runs.append(run)
        run = []
    runs.append(run)
    if opened or not any(runs):
        raise ValueError("an optional region is open, or no wording is mandatory")
    made.end, made.anchor = state, b" ".join(max(runs, key=lambda r: len(b" ".join(r))))
    return made


def scan(text: bytes, automata: dict[str, Automaton]) -> tuple:
    """(words, base places, first and last start, base labels, all labels, score, template places)"""
    words = text.translate(FOLD).split()
    joined = b" " + b" ".join(words) + b" "
    n_base, first, last, base = 0, None, None, set()
    for phrase, label in PHRASES:
        # Words are counted on from the place before, so that a text is read once for each phrase.
        needle, at, seen, word = b" " + phrase.encode() + b" ", -1, 0, 0
        while (at := joined.find(needle, at + 1)) >= 0:
            word, seen = word + joined.count(b" ", seen, at), at
            n_base, first, last = n_base + 1, word if first is None else min(first, word), word if last is None else max(last, word)
            base.add(label)
    places = {name: found for name, a in automata.items() if (found := a.find(words, joined))}
    n = n_base + 2 * sum(map(len, places.values()))
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | set(places))), 1 - 0.5**n, places


_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,start:long,end:long>>"
_ARROW = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("matches", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


def scan_licenses(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document with its phrase counts, labels, score and the templates' places (in words)."""
    automata = {name: compile_template(t) for name, t in (TEMPLATES if templates is None else templates).items()}
    names = _ARROW.names

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        found = [scan(t, automata) for t in utf8(batch.column("text"))]
        out = {"doc_id": batch.column("doc_id").to_pylist()} | {n: [f[i] for f in found] for i, n in enumerate(names[1:8])}
        return out | {"matches": [[{"label": k, "start": a, "end": b} for k in sorted(f[7]) for a, b in f[7][k]] for f in found]}

    return by_batch(id_and_text(df, id_col, text_col), run, _SCHEMA, _ARROW)


def op7_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of every document."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("matches")
