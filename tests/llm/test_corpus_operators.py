import hashlib
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardfold.llm import decontaminate, extract_text, fingerprint, kdshard, neardup, packing, sanitise, substring, toxicity, urlfilter
from cardfold.llm import queries as corpus
from cardfold.llm.common import tokenizer_path
from cardfold.llm.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
BASE = [f"alpha{i}" for i in range(60)]
ROWS = [
    (1, " ".join(BASE), "x"),
    (2, " ".join(BASE), None),
    (3, " ".join(BASE[:55] + ["new"] * 5), "x"),
    (4, None, "y"),
    (5, "", "y"),
    (6, " \n\t ", None),
    (7, "one two", "y"),
    (8, LONG, "x"),
    (8, LONG, "x"),
    (9, "tail " + " ".join(BASE[20:40]) + " end", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # The extra columns clash with names that the operators use inside.
    rows = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string").repartition(3)
    return rows.withColumns({"found": F.lit(1), "score": F.lit("s"), "spans": F.lit(2), "row": F.lit(3), "source": F.lit("s"), "id": F.lit(4)})


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    got = corpus.queries()[name](spark, SF_DIR)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(cursor.fetchall())


def test_substring_edges(docs):
    got = {(r.id, r.n_words, len(r.kept.split())) for r in substring.deduplicate(docs, chunk_bytes=20_000).collect()}
    assert got == {(1, 60, 60), (2, 60, 0), (3, 60, 5), (4, 0, 0), (5, 0, 0), (6, 0, 0), (7, 2, 2), (8, 30_000, 30_000), (9, 22, 2)}
    assert substring.deduplicate(docs.where("doc_id < 0")).count() == 0


def test_shards_are_even_and_slots_gapless(spark, docs):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("a"), (F.col("id") % 97).cast("int")).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("source"),
    )
    got = kdshard.shard(rows, shards=7).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 2 * got["size"].max()
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard")["slot"])
    edge = kdshard.shard(docs, shards=4).collect()
    assert len(edge) == len(ROWS) and {r.text_crc32 for r in edge if r.id == 4} == {0}
    assert kdshard.shard(docs.where("doc_id < 0"), shards=3).count() == 0


def test_main_text():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class=ad>Buy, now.</div>"
        "<article><h1>Head</h1><p>One &amp; two,<br>three.<p>Short.</article><div id=comments><p>Nice.</p></div>"
        "<form>send</form><script>var t='</p>';</script><footer>c</footer>"
    )
    assert extract_text.main_text(page) == "Head\n\nOne & two, three.\n\nShort."
    plain = page.replace("article", "div")
    assert extract_text.main_text(plain) == "Head\n\nOne & two, three.\n\nShort."
    assert extract_text.main_text(None) == extract_text.main_text("") == ""


@pytest.mark.parametrize(
    "name", ["content with-sidebar", "layout no-sidebar", "elementor-widget-theme-post-content", "section-header", "sidebar", "legal", "side widget"]
)
def test_hints_keep_the_article(name):
    body = "<h1>Head</h1><h2 class='section-header'>Part</h2>" + "<p>One, two, three. Four is more.</p>" * 4
    want = "Head\n\nPart" + "\n\nOne, two, three. Four is more." * 4
    other = "<div class='sidebar-left'>Ad, ad.</div><div id=comments><article><p>" + "Nice, nice. " * 90 + "</article></div>"
    for tag in ("article", "div"):
        page = f"<body><div class='{name}'><{tag}>{body}</{tag}></div>{other}"
        assert extract_text.main_text(page) == want


@pytest.mark.parametrize("tag", ["article", "div"])
def test_lists_tables_and_long_blocks_stay(tag):
    item, para, huge = "<li>milk eggs</li>", "<p>" + "Some words, and more of them here. " * 12 + "</p>", "Long words, and long. " * 1000
    parts = f"{para * 6}<ul>{item * 8}</ul><table><tr><td>cell one<td>cell two</table><pre>x = y</pre><section><section><h3>Deep</h3>{para}</section></section>"
    page = f"<body><nav><a href=x>Home</a></nav><{tag}>{parts}<blockquote><p>{huge}</p></blockquote></{tag}><div class=m><ul><li><a href=a>link</a></ul></div>"
    got = extract_text.main_text(page)
    assert got.count("Some words") == 84 and got.count("Long words") == 1000 and got.count("milk eggs") == 8
    assert all(x in got for x in ("cell one", "cell two", "x = y", "Deep")) and "Home" not in got and "link" not in got


def test_teaser_articles_do_not_hide_the_body():
    body = "<p>The body of the page, which is long. It goes on.</p>" * 5
    page = f"<body><div class=story>{body}</div><div class=grid><article><p>A card, short.</article><article><p>Next card.</article></div>"
    assert extract_text.main_text(page).count("The body of the page") == 5


def test_extract_passes_columns(spark):
    pages = spark.createDataFrame([(1, None, "a"), (2, "<p>x</p>" * 2000, "b")], "page_id bigint, html string, text string")
    got = {r.page_id: r.text for r in extract_text.extract(pages).collect()}
    assert got[1] == "" and got[2].count("x") == 2000


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e", "x@y @z.w a@b..c", "1.2.3.4.5.6.7.8", "999.1.1.1.1.1", "+1 (2) 345-678-9012 4111 1111 1111 1111", "@@a@b.co.uk.", "00255.0.0.1 +123456789 "],
)
def test_base_spans_equal_the_patterns(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    want = []
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            right = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0}
            right |= {"card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}
            if right[kind]:
                want.append((kind, *m.span()))
    assert sorted(sanitise.base_spans(text)) == sorted(want)


def test_revealing_terms_are_generalised(spark):
    rows = [(i, f"filler word{i} agent K77b mail joe@site.example now", "x") for i in range(4)]
    rows += [(10 + i, f"filler agent text number{i} now", "x") for i in range(40)] + [(90, None, "x"), (91, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = {r.doc_id: r.text for r in sanitise.sanitise(docs, spans_col="own").collect()}
    assert got[1] == "filler word1 agent x00x xxxx [EMAIL] now"
    assert got[10] == rows[4][1] and got[90] is None and got[91] == ""
    assert sanitise.sanitise(docs.where("doc_id < 0")).count() == 0


def test_terms_of_rare_entities_are_judged(spark):
    rows = [(1, "filler agent K77b mail joe@site.example now"), (2, "filler Q5z ann@site.example now"), (3, "now Q5z by ann@site.example filler")]
    rows += [(10 + i, f"filler agent mail by text number{i} now") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert got[1] == "filler agent x00x mail [EMAIL] now"
    assert got[2] == "filler x0x [EMAIL] now" and got[3] == "now x0x by [EMAIL] filler"
    assert all(got[i] == text for i, text in rows[3:])


def test_revealing_terms_go_from_whole_texts(spark):
    far = " ".join(f"filler word{i}" for i in range(30))
    rows = [(i, f"agent (K77b), joe@site.example now filler {far} then k77B's K77B; ") for i in range(4)]
    rows += [(5, f"K77b {far} filler"), (6, "y" * 400 + "\u00a0K77b.")]
    rows += [(10 + i, f"filler agent now {far} number{i} K77bc then k77b's") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in sanitise.sanitise(docs, spans_col="own").collect()}
    assert got[1].text == f"agent (x00x), [EMAIL] now filler {far} then k77B's x00x; "
    assert got[5].text == f"x00x {far} filler" and got[6].text == "y" * 400 + "\u00a0x00x."
    assert [(s.kind, s.start, s.stop) for s in got[5].own] == [("term", 0, 4)]
    assert all(got[i].text == text for i, text in rows[6:])


def test_near_terms_are_whole_words():
    text = "long" * 100 + " a@b.example " + "word" * 100 + " x"
    words = sanitise._words(text, spans := sanitise.base_spans(text))
    assert list(sanitise._near(words, spans, 1)) == [(0, "long" * 100), (0, "word" * 100)]


def test_decontaminate_edges(spark, docs):
    items = [(1, " ".join(BASE[20:36])), (1, None), (2, "one two"), (None, "!!")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (10, 1 << 20):
        found = decontaminate.find_matches(docs.drop("found"), bench, block_bytes=block).collect()
        hits = {(r.doc_id, r.found.longest, tuple(r.found["items"])) for r in found if r.found["items"]}
        assert hits == {(1, 16, ("1",)), (2, 16, ("1",)), (3, 16, ("1",)), (9, 16, ("1",)), (7, 2, ("2",))}
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 8, 8]
    assert decontaminate.decontaminate(docs, bench.where("item_id < 0")).count() == len(ROWS)


def test_near_duplicate_edges(spark, docs):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}
    assert {(1, 56, 1, True), (2, 56, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True)} <= got
    assert (3, 56, 1, False) in got
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 8, 8, 9]
    assert neardup.near_duplicates(docs.where("doc_id < 0")).count() == 0


def test_url_rules_nest(spark):
    urls = ["http://a.Example.NET/en/x", "https://net/", "http://xnet/en/", None, "nourl", "http://b.org", "ftp://q.example.net/de?/en/", "://", "http://net"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    rules = spark.createDataFrame(corpus.RULES, "verdict string, host string, path string")
    got = {r.page_id: (r.url_rule, r.url_verdict) for r in urlfilter.match(pages, rules).collect()}
    want = {i: (None, "allow") for i in range(len(urls))}
    want |= {0: ("example.net/en/", "allow"), 1: ("net/", "block"), 6: ("net/", "block")}
    assert got == want


def test_packing_round_trip(spark, docs):
    pieces = packing.tokenized_pieces(docs, tokenizer_path())
    rows = packing.pack(pieces).toPandas()
    assert (rows.groupby("sequence_id").length.sum() <= 2048).all()
    at = rows.sort_values(["sequence_id", "offset"])
    assert (at.groupby("sequence_id").length.cumsum() - at.length == at.offset).all()
    assert rows[rows.id.isin([4, 5, 6])].length.tolist() == [1, 1, 1]
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 2048) + 1
    assert packing.pack(pieces.where("id < 0")).count() == 0


def test_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    texts = ["don't it's ''s", "", "a<|endoftext|>b", "café İx २½ a1b22", "a\x85b\xa0c\x1cd", "ABC.,;d!!e 漢字"]
    tool = Tokenizer.from_file(tokenizer_path())
    want = [e.ids for e in tool.encode_batch(texts, add_special_tokens=False)]
    got = packing.WordTokenizer(tokenizer_path()).encode(texts)
    assert [list(memoryview(b).cast("I")) for b in got] == want


def test_fingerprint_containment(spark, docs):
    rows = fingerprint.with_sketch(docs.select("doc_id", "text"), "text", "sketch", scale=1)
    by_id = {r.doc_id: set(r.sketch) for r in rows.collect()}
    assert len(by_id[1]) == 56 and by_id[1] == by_id[2] and by_id[4] == by_id[6] == set() and len(by_id[7]) == 1
    assert len(by_id[1] & by_id[3]) == 51
    rows = fingerprint.with_next(rows, "doc_id", "text", ["doc_id"], parts=3).select("doc_id", "next_doc_id").collect()
    assert Counter(map(tuple, rows)) == Counter([(9, 8), (8, 8), (8, 7), (7, 6), (6, 5), (5, 4), (4, 3), (3, 2), (2, 1), (1, 9)])


def test_short_texts_inside_long_ones(spark):
    long = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(long[20 * i : 20 * i + 5 + i % 9]), " ".join(long)) for i in range(140)]
    rows += [(900, "not in the long text", " ".join(long)), (901, "", "a b"), (902, " ", None)]
    df = spark.createDataFrame(rows, "id int, short string, long string")
    for name in ("short", "long"):
        df = fingerprint.with_sketch(df, name, f"{name}_sketch", all_out=f"{name}_all")
    own, other = ((F.col(f"{n}_sketch"), F.col(f"{n}_all")) for n in ("short", "long"))
    near = fingerprint.containment(own[0], other[0], own[1], other[1]).alias("near")
    got = {r.id: r for r in df.select("*", near, fingerprint.fingerprint(*own).alias("print")).collect()}
    assert all(got[i].near == 1 for i in range(140)) and [got[i].near for i in (900, 901, 902)] == [0, 0, 1]
    assert all(set(r.short_sketch) <= set(r.long_sketch) for r in got.values() if r.id < 140)
    assert len({got[i].print for i in range(140)}) == 140 and got[901].print == ""


def test_counterfactual_penalty_and_held_out_accuracy(spark):
    names = {"idiot": 0, "muslim": 1, "jewish": 2}
    rows = [(1, [0, 1], [0, 2])] * 20 + [(0, [2], [1])] * 20 + [(0, [], None)] * 20 + [(1, [0], None)] * 20
    free = toxicity.fit(names, rows, 0.0, 0.01, 300).weights
    tied = toxicity.fit(names, rows, 5.0, 0.01, 300).weights
    gap = [abs(w.get("muslim", 0) - w.get("jewish", 0)) for w in (free, tied)]
    assert gap[1] < 0.2 * gap[0] and tied["idiot"] > 1
    got = corpus.op10_toxicity(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert not any(r.predicted and not r.toxic for r in rows)


def test_toxicity_edges(spark, docs):
    model = toxicity.Model({"one": 0}, [3.0], -1.0)
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 8, 8, 9]
    assert toxicity.model_of(docs, spark.createDataFrame([], "doc_id bigint, toxic int")).scores([None]) == pytest.approx([0], abs=1e-9)


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).toPandas()
    sources = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").toPandas().doc_id
    assert 0 < rows.doc_id.nunique() < len(sources) and set(rows.doc_id) <= set(sources)
    assert all(zlib.crc32(b"") != c for c in rows.ids_crc32) and hashlib.sha256(b"").hexdigest()


def test_neardup_holds_few_texts_outside_the_heap(spark, monkeypatch):
    """Python gets small batches in any session, and texts are read once for the open buckets."""
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*words, *(f"x{i}y{j}" for j in range(3))])) for i in range(6)]
    docs += [(10, " ".join(f"z{j}" for j in range(40))), (11, None)]
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def spied(df, label, store=neardup.store):
        seen.append((label, int(spark.conf.get(key)), df._jdf.queryExecution().sparkPlan().toString().count("text:string")))
        return store(df, label)

    monkeypatch.setattr(neardup, "store", spied)
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)
    assert {r.doc_id: r.component_id for r in got} == {**dict.fromkeys(range(6), 0), 10: 10, 11: 11}
    assert max(rows for _, rows, _ in seen) <= 512
    assert [texts for label, _, texts in seen if label == "found"][-1] == 1


def test_tokenizing_holds_few_texts_outside_the_heap(spark, docs, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}

    def spied(df, label, store=packing.store):
        seen[label] = int(spark.conf.get(key))
        return store(df, label)

    monkeypatch.setattr(packing, "store", spied)
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        packing.pack(packing.tokenized_pieces(docs, tokenizer_path()))
        assert seen["pieces"] <= 512 and spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)
