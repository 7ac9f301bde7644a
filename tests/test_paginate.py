import random

import pytest
from pyspark.sql import functions as F

from cardfold.operators.paginate import paginate

FACTS = (
    "url string, error_type string, error_message string, status_code int, "
    "fetched_at timestamp, next_url string, n_cards int, named array<int>, "
    "cards array<struct<card:int,business_name:string,trade_category:string,region:string,"
    "description:string,phone_text:string,phone_href:string,listing_url:string>>"
)


def page(url, names, next_url=None):
    cards = [(i, n, None, None, None, None, None, None) for i, n in enumerate(names)]
    named = [i + 1 for i, n in enumerate(names) if n]
    return (url, None, None, None, None, next_url, len(names), named, cards)


def failed(url, kind="Timeout", status=None):
    return (url, kind, "timed out", status, None, None, None, None, None)


def run(spark, pages, seeds, limit, max_pages):
    facts = spark.createDataFrame(pages, FACTS)
    starts = spark.createDataFrame(list(enumerate(seeds)), "seq int, url string")
    out = paginate(starts, facts, limit, max_pages)
    visits = [(r.seq, r.url, r.ok) for r in out.visits.orderBy("seq", "step").collect()]
    rows = [(r.source_url, r.business_name) for r in out.listings.orderBy("ord").collect()]
    fails = [(r.url, r.error_type) for r in out.failures.orderBy("ord").collect()]
    return visits, rows, fails


def model(pages, seeds, limit, max_pages):
    by_url = {p[0]: p for p in pages}
    visits, rows, fails = [], [], []
    for seq, url in enumerate(seeds):
        seen, got, read = set(), 0, 0
        while url is not None and url not in seen and got < limit:
            if max_pages and read >= max_pages:
                break
            seen.add(url)
            found = by_url.get(url)
            if found is None or found[1]:
                visits.append((seq, url, False))
                fails.append((url, found[1] if found else "NotInSnapshot"))
                break
            visits.append((seq, url, True))
            read += 1
            taken = [c[1] for c in found[8][: limit - got] if c[1]]
            rows += [(url, name) for name in taken]
            got += len(taken)
            url = found[5]
    return visits, rows, fails


def test_limit_spans_pages(spark):
    pages = [page("p1", ["1", "2"], "p2"), page("p2", ["3", "4"])]
    visits, rows, fails = run(spark, pages, ["p1"], 3, 2)
    assert rows == [("p1", "1"), ("p1", "2"), ("p2", "3")]
    assert visits == [(0, "p1", True), (0, "p2", True)] and fails == []


def test_failed_page(spark):
    assert run(spark, [failed("p1")], ["p1"], 10, 1) == ([(0, "p1", False)], [], [("p1", "Timeout")])


def test_cycle_without_page_limit(spark):
    pages = [page("p1", ["1"], "p2"), page("p2", ["2"], "p3"), page("p3", ["3"], "p1")]
    visits, rows, _ = run(spark, pages, ["p1", "p3"], 99, 0)
    assert [v[1] for v in visits] == ["p1", "p2", "p3", "p3", "p1", "p2"]
    assert [r[1] for r in rows] == ["1", "2", "3", "3", "1", "2"]


def test_budget_left_by_nameless_cards(spark):
    pages = [
        page("a", ["1", "2", "3"], "b"),
        page("b", [None, "4", "5"], "c"),
        page("c", [None, None, "x"], "d"),
        page("d", [], "e"),
        page("e", ["6", "7"], "f"),
        page("f", ["8"]),
    ]
    visits, rows, _ = run(spark, pages, ["a"], 5, 0)
    assert (visits, rows) == model(pages, ["a"], 5, 0)[:2]
    assert [r[1] for r in rows] == ["1", "2", "3", "4", "6"]


def test_long_chain(spark):
    pages = [page(f"p{i}", [str(i)], f"p{i + 1}") for i in range(300)]
    visits, rows, fails = run(spark, pages, ["p0", "p150"], 1000, 0)
    assert (visits, rows, fails) == model(pages, ["p0", "p150"], 1000, 0)
    assert fails == [("p300", "NotInSnapshot")] * 2


def test_many_pages_lead_to_one(spark):
    pages = [page(f"p{i}", ["n"], "p0") for i in range(50)]
    seeds = [f"p{i}" for i in range(50)]
    assert run(spark, pages, seeds, 5, 0) == model(pages, seeds, 5, 0)


@pytest.mark.parametrize("seed", range(6))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    pages, seeds = [], []
    for g in range(25):
        n = rng.randint(1, 9)
        urls = [f"g{g}/{i}" for i in range(n)]
        for i, url in enumerate(urls):
            if rng.random() < 0.1:
                pages.append(failed(url, "HTTPError", 503))
                continue
            after = urls[i + 1] if i + 1 < n and rng.random() < 0.7 else rng.choice([*urls, None, f"g{g}/x"])
            names = [rng.choice(["n", "n", None]) for _ in range(rng.randint(0, 5))]
            pages.append(page(url, names, after))
        seeds += rng.sample(urls, min(n, 3))
    limit, cap = rng.choice([1, 2, 4, 7, 100]), rng.choice([0, 0, 1, 2, 4])
    assert run(spark, pages, seeds, limit, cap) == model(pages, seeds, limit, cap)


def test_arguments(spark):
    for limit, cap in ((0, 1), (1, -1)):
        with pytest.raises(ValueError):
            run(spark, [page("a", [])], ["a"], limit, cap)
