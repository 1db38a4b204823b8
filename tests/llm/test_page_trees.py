"""Trees of pages are aligned whole, however wide and deep they are."""

import json
import random

import pytest

from marginalia.llm import html_extract, html_tree


def listed(labels):
    return html_tree.Shape("page", [html_tree.Shape(x) for x in labels])


def most_by_plain_steps(ones, others):
    best = [0] * (len(others) + 1)
    for a in ones:
        last = 0
        for j, b in enumerate(others):
            last, best[j + 1] = best[j + 1], max(best[j + 1], best[j], last + 1 if a == b else 0)
    return best[-1]


def test_long_lists_are_matched_as_well_as_short_ones():
    labels = ["p", "h2"] * 300
    one, other = listed(["pre", *labels]), listed([*labels[:400], "pre", *labels])
    count, pairs = html_tree.matched(one, other)
    assert count == len(pairs) == 1 + 601
    rnd = random.Random(4)
    for n, m in ((520, 700), (1, 2000), (900, 300)):
        ones, others = (rnd.choices("abcdefgh", k=k) for k in (n, m))
        one, other = listed(ones), listed(others)
        count, pairs = html_tree.matched(one, other)
        at = [({id(c): k for k, c in enumerate(x.children)}) for x in (one, other)]
        places = [(at[0][id(a)], at[1][id(b)]) for a, b in pairs[1:]]
        assert count == len(pairs) == 1 + most_by_plain_steps(ones, others)
        assert all(ones[i] == others[j] for i, j in places)
        assert all(i < k and j < l for (i, j), (k, l) in zip(places, places[1:]))


def deep_page(i, depth):
    return "<div><h2>" * (depth // 2) + f"<div class=advert>Buy {i}</div><article><p>Story {i}</p><p>Same words</p></article>" + "</h2></div>" * (depth // 2)


@pytest.mark.parametrize("depth", [100, 400, 4000])
def test_deep_pages_have_all_their_parts(spark, depth):
    pages = [(i, "http://deep.example/", deep_page(i, depth)) for i in range(6)]
    pages += [(10 + i, "http://deep.example/", deep_page(10 + i, depth + 20)) for i in range(2)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = {r["page_id"]: r["text"] for r in html_extract.extracted(df).collect()}
    assert {rows[i] for i in range(6)} == {f"Story {i}" for i in range(6)}
    shape = html_tree.shape_of(html_tree.parsed(pages[0][2]))
    assert len(list(html_tree.preorder(shape))) == 2 * (depth // 2) + 4
    slot = html_extract.slot_of(shape)
    again = html_extract.loaded(json.loads(json.dumps(slot.dumped())))
    assert again.dumped() == slot.dumped() and html_tree.skeleton(again) == html_tree.skeleton(shape)
