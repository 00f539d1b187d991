"""Rows and texts that an operator once lost or took for others."""

from __future__ import annotations

import random

import pytest

from storelens.llm import chat, contamination, html_tree, license_scan, neighbours, site_tree
from tests.llm.cases import prose
from tests.llm.test_text_operators import plain_items


def kept(html):
    return [b for *_, b in site_tree.main_blocks(html_tree.parse(html))]


def test_names_never_make_a_main_part_noise():
    page = "<nav>Menu</nav>{}<footer>f</footer>"
    for whole in ('<body class="no-sidebar"><article>x y</article></body>', '<body class="page header-fixed sidebar">x y</body>',
                  '<main class="with-sidebar">x y</main>', '<article class="post comments-open">x y</article>',
                  '<main id="sidebar" class="ad">x y</main>', '<div class="sidebar"><main>x y</main></div>',
                  '<form><div><article>x y</article></div></form>', '<header><div><p>x y</div></header>',
                  '<div role="banner"><article>x y</article></div>', '<body role="search"><p>x y</body>',
                  '<div class="widget"><p>x y</div>', '<main><h1>x</h1><div class="share"><p>y long text</div></main>'):
        assert " ".join(kept(page.format(whole))).startswith("x") and "y" in " ".join(kept(page.format(whole))), whole
        assert not {"Menu", "f"} & set(kept(page.format(whole))), whole
    # a head or nav left open does not swallow the page
    assert kept("<head><title>t</title><body><p>x") == ["x"]
    assert kept("<nav>Menu<main>x</main>") == ["x"]


def test_named_noise_stays_noise_beside_the_main_part():
    assert kept('<article>long enough<div class="comments">c</div></article><div class="related"><article>r</article></div>') \
        == ["long enough"]
    assert kept('<main>long enough<div id="Share_Buttons">s</div><div class="no-share">t</div></main>') == ["long enough", "t"]
    # no other main part: the counts decide on the article in named noise, and the text beside it is not lost
    assert kept('<div class="x">the long text of it</div><div class="related"><article>r</article></div>') == \
        ["the long text of it", "r"]


def test_site_counts_decide_on_named_branches_with_most_of_the_text(spark):
    rows = [(i, f"http://big.com/{i}", f'<main><h1>{prose(i, 2)}</h1><div class="widget"><div class=a>{prose(i + 100, 20)}</div>'
             f'<div class=b>the same words on every page, again</div></div></main>') for i in range(40)]
    got = site_tree.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    for r in got:
        assert r.text == " ".join(prose(r.page_id, 2).split()) + "\n\n" + " ".join(prose(r.page_id + 100, 20).split())


GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so"""
NOTICE = """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""
WARRANTY = """

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ADVERT = """3. All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the organization.
4. """
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as
published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {0} for more details."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License.  You may obtain a copy of the License at
    https://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.  See the License for the
specific language governing permissions and limitations under the License."""
SCAN = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES).scan


def whole_labels(text):
    return {s["label"] for s in SCAN(text)[7]} & set(license_scan.TEXTS)


@pytest.mark.parametrize("text, label", [
    (GRANT + NOTICE + WARRANTY, "mit-license"), (GRANT + "." + WARRANTY, "mit-0"),
    (GRANT + NOTICE + "\nThe Software shall be used for Good, not Evil." + WARRANTY, "json-license"),
    (GRANT + NOTICE + WARRANTY + " Except as contained in this notice, the name of the X Consortium shall not be used in "
     "advertising or otherwise to promote the sale, use or other dealings in this Software without prior written "
     "authorization from the X Consortium.", "x11"),
    (CONDITIONS + DISCLAIMER, "bsd-2-clause"), (CONDITIONS + NAMES + DISCLAIMER, "bsd-3-clause"),
    (CONDITIONS + ADVERT + NAMES[3:] + DISCLAIMER, "bsd-4-clause"),
    (GNU.format("General Public License", 3), "gpl-3.0-notice"), (GNU.format("General Public License", 2), "gpl-2.0-notice"),
    (GNU.format("Lesser General Public License", "2.1"), "lgpl-2.1-notice"), (APACHE, "apache-2.0-header")])
def test_a_license_is_its_whole_wording(text, label):
    assert whole_labels(f"Copyright 2020 me\n{text}\nand some code") == {label}
    assert SCAN(text)[6] == 1.0
    words = text.split()
    k = max(i for i, w in enumerate(words) if w.lower() == "of")
    assert label not in whole_labels(" ".join(words[:k] + ["hardly"] + words[k:]))       # altered near the end
    assert label not in whole_labels(" ".join(words[:k]))                                # broken off


def test_near_variants_of_licenses_are_refused():
    opening = GRANT + ", for research only." + WARRANTY
    for text in (opening, CONDITIONS + "3. Not for military use." + DISCLAIMER, CONDITIONS,
                 GNU.format("Affero General Public License", 3), GNU.format("General Public License", 4),
                 GRANT + NOTICE + " Only on Sundays." + WARRANTY):
        assert not whole_labels(text)
    assert SCAN(opening)[5:7] == SCAN(CONDITIONS)[5:7] == ("", 0.0)              # an opening alone tells no license


def test_whole_license_texts_are_accepted(spark):
    texts = [license_scan._whole(k).replace("[[", "").replace("]]", "").replace("{{scheme:1-1}}", "https")
             for k in license_scan.TEXTS if k.endswith("-text")]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [set(r.labels.split(",")) for r in license_scan.scan_licenses(df).collect()]
    assert [{x for x in g if x.endswith("-text")} for g in got] == [{k} for k in license_scan.TEXTS if k.endswith("-text")]


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_rows_without_conv_id_are_conversations_of_their_own(spark):
    rows = [(None, i % 3, "assistant", f"a{i % 7}") for i in range(50)] + [(None, 0, "user", "u")] * 5
    rows += [(1, 0, "user", "q"), (1, 1, "assistant", "r")]
    talks = chat.conversations(spark.createDataFrame(rows, TURNS))
    assert sorted(len(r.turns) for r in talks.collect()) == [1] * 55 + [2]
    got = chat.format_preferences(chat.reply_pairs(talks)).collect()
    assert sum(r.conv_id is None for r in got) == 55 and len(got) == 56
    said = lambda i: f"<|assistant|>\na{i}<|end|>\n"
    asked = [r for r in got if r.prompt.startswith("<|user|>") and r.conv_id is None]
    assert len(asked) == 5 and all((r.n_common, r.chosen, r.rejected) == (1, "", "") for r in asked)
    got = [r for r in got if r not in asked]
    seen = [r.prompt or r.chosen for r in got if r.conv_id is None]
    assert sorted(seen) == sorted(said(i % 7) for i in range(50))
    # of equal replies all but one are followed by their equal
    assert sum(r.n_common == 1 for r in got if r.conv_id is None) == 50 - 7


def test_repeated_turns_are_counted(spark):
    rows = [(1, None, "user", "hm"), (1, None, "user", "hm"), (1, 4, "user", "x"), (1, 4, "user", "x"), (1, 4, "user", "x"),
            (1, 5, "assistant", "y")]
    (talk,) = chat.conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert [tuple(t) for t in talk.turns] == [("user", "hm", 1), ("user", "hm", 1), ("user", "x", 3), ("assistant", "y", 1)]


def test_one_id_is_spread_over_ranges(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice([None, None, 7, rng.randint(0, 9)]), rng.randint(-40, 40)) for _ in range(3000)]
    rows += [(7, 5)] * 2500 + [(None, -3)] * 1500
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = [(*r, *order[(i + 1) % len(order)]) for i, r in enumerate(order)]
    df = spark.createDataFrame(rows, "id bigint, tie bigint")
    for hot in (10_000, 100):
        monkeypatch.setattr(neighbours, "HOT_ROWS", hot)
        got = neighbours.with_next(df, "id", "tie", {"nid": "id", "ntie": "tie"}).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    place = neighbours.F.struct(neighbours.F.lit(True).alias("set"), "id", "tie")
    starts = neighbours._range_starts(df.where("id = 7").select(place.alias("place")), 8)
    assert len(starts) > 3


def test_repetitive_items_need_no_more_functions(spark):
    items = [(0, "la " * 800), (1, "tick tock " * 300), (2, prose(4, 60)), (3, "one two three four five"),
             (4, "la " * 60 + prose(5, 5)), (5, prose(6, 700))]
    index = contamination.ItemIndex([i for i, _ in items], [t for _, t in items], 5, 0.8)
    assert len(index.odd) <= contamination.MAX_FUNCTIONS
    docs = [(i, prose(50 + i, 9000) + " " + t + " " + prose(80 + i, 4000)) for i, t in items]
    docs += [(10, "la la la la"), (11, "la la la la la"), (12, "tick tock tick tock tick tock"), (13, "one two three four")]
    found = contamination.find_items(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                     spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = sorted(((r.doc_id, h.item_id, round(h.containment, 9)) for r in found for h in r["items"]), key=repr)
    assert got == plain_items(docs, items) and len(got) > 8
    only = contamination.ItemIndex([0], ["la " * 800], 5, 0.8)
    assert only.contained("x " + "la " * 9) == [(0, 1.0, 1)]
