"""License scan: template mark-up compiled into token automata.

A template is wording with two kinds of regions:

    [[ ... ]]        optional: may be there or not
    {{name}}         replaceable: any run of words, none and very long ones too
    {{name:1-3}}     replaceable: a run of 1 to 3 words

Everything outside is mandatory and must match word for word.  Texts and
templates are cut into the same words (A-Z lower-cased; runs of characters other
than ASCII punctuation and white space), so case, punctuation and line breaks
never matter.  ``compile_template`` turns a template into a small automaton
whose states are places in the wording.  ``spans`` runs it once over a text for all
places where the wording may start: a state remembers only the latest start that
reached it, as what follows is the same for all, so the work is at most the text's
words times the template's states, and next to nothing where no start is alive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import column, free_name, texts_in_small_batches
from storelens.llm.words import plain_words

# Base phrases: places where these words stand consecutively.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# One-line notices.
NOTICES = {
    "gpl-notice": "licensed under the [[terms of the]] GNU General Public License"
                  "[[, version {{number:1-1}}]] [[or {{later:0-6}} later [[version]]]]",
    "gpl-2.0": "GNU General Public License[[,]] version 2 [[of the License]]",
    "gpl-3.0": "GNU General Public License[[,]] version 3 [[of the License]]",
    "apache-2.0": "licensed under the Apache License, Version 2.0 [[(the \"License\")]]",
    "mit-notice": "[[is]] released under the [[terms of the]] MIT License",
    "cc-by-4.0": "licensed under [[a]] [[Creative Commons]] CC BY 4.0",
    "cc-by-nc-4.0": "licensed under [[a]] [[Creative Commons]] CC BY-NC 4.0",
    "cc-by-sa-4.0": "licensed under [[a]] [[Creative Commons]] CC BY-SA 4.0",
}
_BSD_OPENING = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions are met")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this {{software:1-4}} and "
              "associated documentation files [[(the \"{{name:1-3}}\")]], to deal in the {{name:1-3}} without restriction, "
              "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
              "and/or sell copies of the {{name:1-3}}, and to permit persons to whom the {{name:1-3}} is furnished to do so")
_MIT_NOTICE = ("subject to the following conditions: The above copyright {{notice:1-1}} and this permission notice "
               "[[(including the next paragraph)]] shall be included in all copies or substantial portions of the "
               "{{name:1-3}}.")
_MIT_WARRANTY = ("THE {{name:1-3}} IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                 "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
                 "IN NO EVENT SHALL {{holders}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
                 "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE {{name:1-3}} OR THE USE "
                 "OR OTHER DEALINGS IN THE {{name:1-3}}.")
_BSD_TWO = (_BSD_OPENING + ": [[1.]] [[a)]] Redistributions of source code must retain the above copyright notice, "
            "this list of conditions and the following disclaimer. [[2.]] [[b)]] Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution.")
_BSD_NAMES = (" Neither the {{name:1-1}} of {{holder}} nor the names of [[its]] contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")
_BSD_WARRANTY = (" THIS SOFTWARE IS PROVIDED BY {{holders}} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
                 "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                 "DISCLAIMED. IN NO EVENT SHALL {{holders}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
                 "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
                 "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
                 "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
                 "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu_notice(name: str, version: str) -> str:
    return (f"is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
            f"the Free Software Foundation; [[either]] version {version} [[of the License]] [[only]] [[or (at your "
            "option) any later version]]. {{program:1-6}} is distributed in the hope that it will be useful, but WITHOUT "
            "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
            f"the {name} for more details. [[You should have received a copy of the {name} along with "
            "{{program:1-6}}]]")


def _whole(label: str) -> str:
    return resources.files(__package__).joinpath("licenses", f"{label}.txt").read_text(encoding="utf-8")


# Whole grants, headers and license texts: the conditions and disclaimers are mandatory too.
TEXTS = {
    "mit-license": f"{_MIT_GRANT}, {_MIT_NOTICE} {_MIT_WARRANTY}",
    "mit-0": f"{_MIT_GRANT}. {_MIT_WARRANTY}",
    "json-license": f"{_MIT_GRANT}, {_MIT_NOTICE} The Software shall be used for Good, not Evil. {_MIT_WARRANTY}",
    "x11": f"{_MIT_GRANT}, {_MIT_NOTICE} {_MIT_WARRANTY} Except as contained in this notice, the {{{{name:1-1}}}} of {{{{holder}}}} "
           "shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software "
           "without prior written authorization from {{holder:1-12}}",
    "bsd-2-clause": _BSD_TWO + _BSD_WARRANTY,
    "bsd-3-clause": f"{_BSD_TWO} [[3.]] [[c)]]{_BSD_NAMES}{_BSD_WARRANTY}",
    "bsd-4-clause": f"{_BSD_TWO} [[3.]] [[c)]] All advertising materials mentioning features or use of this software must "
                    "display the following {{word:1-1}}: This product includes software developed by {{holder}}. "
                    f"[[4.]] [[d)]]{_BSD_NAMES}{_BSD_WARRANTY}",
    "gpl-2.0-notice": _gnu_notice("GNU General Public License", "2"),
    "gpl-3.0-notice": _gnu_notice("GNU General Public License", "3"),
    "lgpl-2.1-notice": _gnu_notice("GNU Lesser General Public License", "2.1"),
    "lgpl-3.0-notice": _gnu_notice("GNU Lesser General Public License", "3"),
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at {{scheme:1-1}}://[[www.]]"
                         "apache.org/licenses/LICENSE-2.0[[.txt]] [[.html]] Unless required by applicable law or agreed to "
                         "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                         "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                         "specific language governing permissions and limitations under the License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                      "MPL was not distributed with this file, You can obtain one at {{scheme:1-1}}://[[www.]]mozilla.org/"
                      "MPL/2.0/",
    **{label: _whole(label) for label in ("apache-2.0-text", "gpl-2.0-text", "gpl-3.0-text", "lgpl-2.1-text",
                                          "lgpl-3.0-text", "mpl-2.0-text")},
}
TEMPLATES = NOTICES | TEXTS


@dataclass(frozen=True)
class Automaton:
    """``edges[s]``: word -> next state; ``wild[s]``: states reached by any word; ``closure[s]``: s and the
    states reached from it without a word; ``final``: the accepting state; ``first``: words it can start with."""

    edges: tuple[dict[bytes, int], ...]
    wild: tuple[tuple[int, ...], ...]
    closure: tuple[tuple[int, ...], ...]
    final: int
    first: frozenset[bytes]

    def spans(self, words: list[bytes], starts: Sequence[int]) -> list[tuple[int, int]]:
        """(start, end) of accepted spans that begin at one of the rising ``starts``: for each start the
        longest, where spans with one end go to the latest start."""
        alive: dict[int, int] = {}
        found: dict[int, int] = {}
        turn, at = 0, 0
        while True:
            if not alive:
                if turn == len(starts):
                    return sorted(found.items())
                at = starts[turn]
            if turn < len(starts) and starts[turn] == at:
                alive.update(dict.fromkeys(self.closure[0], at))
                turn += 1
            if at == len(words):
                return sorted(found.items())
            word, step = words[at], {}
            for state, start in alive.items():
                there = self.edges[state].get(word)
                for to in self.wild[state] if there is None else (there, *self.wild[state]):
                    for reached in self.closure[to]:
                        if step.get(reached, -1) < start:
                            step[reached] = start
            alive, at = step, at + 1
            if self.final in alive:
                found[alive[self.final]] = at

    def accepts_at(self, words: list[bytes], at: int) -> int | None:
        """End of the longest accepted span that starts at word ``at``, or None."""
        return dict(self.spans(words, [at])).get(at)


def compile_template(markup: str) -> Automaton:
    """Build the automaton; raises ValueError on unbalanced mark-up or no mandatory word."""
    edges: list[dict[bytes, int]] = [{}]
    free: list[list[int]] = [[]]
    wild: list[list[int]] = [[]]
    mandatory = 0

    def state() -> int:
        edges.append({})
        free.append([])
        wild.append([])
        return len(edges) - 1

    opened: list[int] = []
    here = 0
    for piece in re.findall(r"\[\[|\]\]|\{\{[^{}]*\}\}|(?:(?!\[\[|\]\]|\{\{).)+", markup, re.S):
        if piece == "[[":
            nxt = state()
            free[here].append(nxt)
            opened.append(here)
            here = nxt
        elif piece == "]]":
            if not opened:
                raise ValueError(f"]] without [[ in {markup!r}")
            nxt = state()
            free[here].append(nxt)
            free[opened.pop()].append(nxt)
            here = nxt
        elif piece.startswith("{{"):
            low, high = re.fullmatch(r"\{\{\w+(?::(\d+)-(\d+))?\}\}", piece).groups()
            if high is None:
                loop, nxt = state(), state()
                free[here].append(loop)
                wild[loop].append(loop)
                free[loop].append(nxt)
            else:
                ends = []
                for taken in range(int(high) + 1):
                    if taken >= int(low):
                        ends.append(here)
                    if taken < int(high):
                        nxt = state()
                        wild[here].append(nxt)
                        here = nxt
                nxt = state()
                for e in ends:
                    free[e].append(nxt)
            here = nxt
        else:
            for word in plain_words(piece):
                nxt = state()
                edges[here][word] = nxt
                here = nxt
                mandatory += not opened
    if opened or not mandatory:
        raise ValueError(f"unbalanced or without mandatory wording: {markup!r}")

    def closure(start: int) -> tuple[int, ...]:
        todo, seen = [start], {start}
        while todo:
            for nxt in free[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return tuple(seen)

    closures = tuple(map(closure, range(len(edges))))
    if any(wild[s] for s in closures[0]):
        raise ValueError(f"a template starts with wording, not a variable: {markup!r}")
    return Automaton(tuple(edges), tuple(map(tuple, wild)), closures, here,
                     frozenset(w for s in closures[0] for w in edges[s]))


class Scanner:
    """``whole``: templates of which only the longest counts where one stands inside another."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], *,
                 whole: frozenset[str] = frozenset(TEXTS)):
        self.whole = whole
        self.phrases = [(b" " + b" ".join(plain_words(p)) + b" ", label) for p, label in phrases.items()]
        self.machines = {label: compile_template(m) for label, m in templates.items()}
        # a text without the rarest mandatory word of a template can't match it
        self.needed = {label: self._needed(m) for label, m in templates.items()}

    @staticmethod
    def _needed(markup: str) -> bytes:
        bare = re.sub(r"\{\{[^{}]*\}\}", " ", markup)
        while "[[" in bare:
            bare = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", " ", bare, flags=re.S)
        return b" " + max(plain_words(bare), key=len) + b" "

    def scan(self, text: str | bytes | None) -> tuple:
        words = plain_words(text)
        line = b" " + b" ".join(words) + b" "
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)     # the k-th stands before word k
        places, base = [], set()
        for phrase, label in self.phrases:
            if found := self._places(line, phrase, gaps):
                places += found
                base.add(label)
        spans, starts = [], {}
        for label, machine in self.machines.items():
            if self.needed[label] not in line:
                continue
            for w in machine.first - starts.keys():
                starts[w] = self._places(line, b" " + w + b" ", gaps)
            here = [starts[w] for w in machine.first]
            spans += [(label, a, e) for a, e in machine.spans(words, here[0] if len(here) == 1 else sorted(set().union(*here)))]
        spans = self._outermost(spans)
        own = {label for label, _, _ in spans}
        score = 1.0 if own else 0.5 if base else 0.0
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | own)), score,
                [{"label": a, "start": s, "end": e} for a, s, e in spans])

    def _outermost(self, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Without the spans of whole wordings that stand inside a longer one's."""
        inner, furthest = set(), None
        texts = sorted((s for s in spans if s[0] in self.whole), key=lambda s: (s[1], -s[2]))
        for span in texts:
            if furthest is not None and span[2] <= furthest[2] and span[1:] != furthest[1:]:
                inner.add(span)
            if furthest is None or span[2] > furthest[2]:
                furthest = span
        return [s for s in spans if s not in inner]

    @staticmethod
    def _places(line: bytes, phrase: bytes, gaps: np.ndarray) -> list[int]:
        """Numbers of the words at which the phrase (with the spaces around it) stands."""
        found, at = [], line.find(phrase)
        while at >= 0:
            found.append(at)
            at = line.find(phrase, at + 1)
        return np.searchsorted(gaps, found).tolist()


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "license_spans")


def scan_licenses(docs: DataFrame, *, text: str = "text", phrases: dict[str, str] | None = None,
                  templates: dict[str, str] | None = None) -> DataFrame:
    """Add COLUMNS to every row (columns of these names are replaced).

    n_base counts all places of all phrases; first_word and last_word are the
    smallest and largest of them (words from 0; null: none).  labels adds the
    templates accepted anywhere in the text; license_spans holds their words
    [start, end).  score is 1 where a template is accepted, 0.5 where only a
    phrase stands, else 0.  A null text is empty: no words, empty labels, 0.
    """
    texts_in_small_batches(docs.sparkSession)
    given = {} if templates is None else {"whole": frozenset()}
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates, **given)
    shape = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
             "labels string, score double, license_spans array<struct<label:string,start:bigint,end:bigint>>")

    @F.pandas_udf(shape)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame([scanner.scan(t) for t in texts], columns=COLUMNS)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    names = [c for c in docs.columns if c.lower() not in COLUMNS]
    (held,) = free_name(docs, "scanned")
    scanned = docs.select(*[column(docs, c) for c in names], scan(column(docs, text).cast("binary")).alias(held))
    return scanned.select(*[f"`{c}`" for c in names], *[F.col(held)[c].alias(c) for c in COLUMNS])
