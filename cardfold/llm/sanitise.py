"""Personal data by information-theoretic sanitisation.

Protected entities are the e-mail addresses, IP addresses, card numbers and phone
numbers that the base patterns find. Corpus co-occurrence then estimates how
strongly a term near an entity reveals it: with document counts over the whole
corpus, PMI(term; entity) = log(p(term, entity) / (p(term) p(entity))), and the
entity's own information is IC = -log p(entity). A term with PMI >= ``disclosure`` *
IC discloses the entity: seeing the term gives away that share of it. No count of
documents is needed for that. A pair met in fewer than ``least_docs`` documents is
judged by a lower bound of its PMI, with the share of the entity's documents that
have the term, p(term | entity), one standard error lower; so a term in every
document of a rare entity counts in full. Such terms are generalised, digits to ``0`` and letters to ``x``, wherever they stand in any text,
with or without an entity beside them; base spans are replaced by their kind.
Co-occurrence is counted within ``context`` whole words on either side of an entity;
a term that only ever stands further away is not judged.

One pass counts terms (per batch, then over the corpus) and gathers the terms
near each entity, so the statistics grow with the corpus. The terms of every
document pass a bit filter of fixed size; what it lets through is joined with the
disclosing terms, so a full filter costs rows, not results.

Defined results. Null or empty text: no spans, text unchanged. Repeated rows are
documents of their own. Ids may be null or repeated (rows are told apart by a
number of their own). Extra columns pass through. Overlapping spans are all
reported; in the text the earliest, then the longest of them is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardfold.llm.common import free_name, slices, store

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT = 5
LEAST_DOCS = 3
DISCLOSURE = 0.8
SLICE_BYTES = 8 << 20
#: Bits of the filter that tasks hold instead of the disclosing terms; its hits are joined with them.
FILTER_BITS, BUCKET_BITS = 24, 15

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits that fails from its start fails from every later digit too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")  # as str.split() cuts
_EDGE = ".,;:!?()[]{}\"'<>"

SPANS = "array<struct<kind:string,start:int,stop:int,value:string>>"
_SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string())])
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points, by start, then kind as listed."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _entity(kind: str, value: str) -> str:
    """The same entity in another spelling is the same entity."""
    return f"{kind}:{value.lower() if kind == 'email' else re.sub('[^0-9.]' if kind == 'ip' else '[^0-9]', '', value)}"


def _gaps(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The parts of the text that no span covers, in order."""
    out, at = [], 0
    for _, start, stop in sorted(spans, key=lambda s: s[1]):
        if start > at:
            out.append((at, start))
        at = max(at, stop)
    return [*out, (at, len(text))] if at < len(text) else out


def _words(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, stop) of all words outside the spans, edge marks left out."""
    out = []
    for start, stop in _gaps(text, spans):
        for m in _WORD.finditer(text, start, stop):
            a, b = m.span()
            while a < b and text[a] in _EDGE:
                a += 1
            while a < b and text[b - 1] in _EDGE:
                b -= 1
            out.append((m.group().lower().strip(_EDGE), a, b))
    return out


def _near(words: list[tuple[str, int, int]], spans: list[tuple[str, int, int]], context: int) -> Iterator[tuple[int, str]]:
    """(span number, term) of the whole words around each span."""
    starts = [a for _, a, _ in words]
    for k, (_, start, stop) in enumerate(spans):
        left, right = bisect_left(starts, start), bisect_left(starts, stop)
        for term, _, _ in words[max(0, left - context) : left] + words[right : right + context]:
            if term:
                yield k, term


def _terms(text: str) -> set[str]:
    """The terms of a text without spans: those of ``_words``."""
    return {t for w in text.lower().split() if (t := w.strip(_EDGE))}


def _statistics(context: int):
    """Rows (entity, term, n): documents of a term (entity null), of an entity (term null), of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([e for e, _ in keys], pa.string()),
                    pa.array([t for _, t in keys], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["entity", "term", "n"],
            )

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for text in part.column("text").to_pylist():
                    if not text:
                        continue
                    spans = base_spans(text)
                    if spans:
                        names = [_entity(k, text[a:b]) for k, a, b in spans]
                        words = _words(text, spans)
                        counts.update({(names[k], t) for k, t in _near(words, spans, context)})
                        counts.update((n, None) for n in set(names))
                        terms = {t for t, _, _ in words if t}
                    else:
                        terms = _terms(text)
                    counts.update((None, t) for t in terms)
                if len(counts) > 300_000:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return run


def disclosures(docs: DataFrame, text_col: str, context: int, least_docs: int, disclosure: float) -> DataFrame:
    """(entity, term): the terms that give an entity away."""
    total = F.lit(docs.count())
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_statistics(context), "entity string, term string, n bigint")
    counts = store(rows.groupBy("entity", "term").agg(F.sum("n").alias("n")), "terms")
    both = counts.where("entity is not null and term is not null")
    of_term = counts.where("entity is null").select("term", F.col("n").alias("n_term"))
    of_entity = counts.where("term is null").select("entity", F.col("n").alias("n_entity"))
    told = both.join(of_term, "term").join(of_entity, "entity")
    share = F.col("n") / F.col("n_entity")
    lower = share - F.sqrt(share * (1 - share) / F.col("n_entity"))
    seen = F.col("n") >= least_docs
    pmi = F.log(F.when(seen, share).otherwise(lower) * total / F.col("n_term"))
    # Without a bound on the count, no information about an entity of every document is not all of it.
    return told.where((pmi >= F.lit(disclosure) * F.log(total / F.col("n_entity"))) & (seen | (pmi > 0))).select("entity", "term")


def _filter_bits(terms: DataFrame) -> bytes:
    """One bit for each value of the terms' CRC-32, cut to ``FILTER_BITS``; as large for any number of terms."""
    value = F.crc32(F.col("term").cast("binary")) % (1 << FILTER_BITS)
    bucket, at = F.shiftright(value, BUCKET_BITS).alias("bucket"), value % (1 << BUCKET_BITS)
    rows = terms.groupBy(bucket).agg(F.bitmap_construct_agg(at).alias("bits")).collect()
    size, out = 1 << (BUCKET_BITS - 3), bytearray(1 << (FILTER_BITS - 3))
    for r in rows:
        out[r["bucket"] * size : (r["bucket"] + 1) * size] = r["bits"]
    return bytes(out)


def _found(names: list[str], text_col: str, spans_col: str, told_col: str, sent, only_private: bool):
    """Adds the base spans, and the terms of the text that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, top = sent.value, (1 << FILTER_BITS) - 1
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                texts = part.column(text_col).to_pylist()
                found = [base_spans(t) if t else [] for t in texts]
                terms = [{w for w, _, _ in _words(t, s)} if s else _terms(t or "") for t, s in zip(texts, found)]
                hits = set()
                for t in set().union(*terms):
                    v = crc32(t.encode()) & top
                    if bits[v >> 3] >> (v & 7) & 1:
                        hits.add(t)
                rows = [
                    [{"kind": k, "start": a, "stop": b, "value": _entity(k, t[a:b])} for k, a, b in s] for t, s in zip(texts, found)
                ]
                told = [list(t & hits) for t in terms]
                if only_private:
                    texts = [t if s or w else None for t, s, w in zip(texts, found, told)]
                columns = [pa.array(texts, pa.string()) if n == text_col else part.column(n) for n in names]
                added = [pa.array(rows, _SPANS_ARROW), pa.array(told, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, *added], [*names, spans_col, told_col])

    return run


def _applied(names: list[str], text_col: str, spans_col: str, told_col: str, only_private: bool):
    """Adds the term spans and rewrites the text of rows with spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans_out = [], []
            rows = zip(batch.column(text_col).to_pylist(), batch.column(spans_col).to_pylist(), batch.column(told_col).to_pylist())
            for text, spans, told in rows:
                spans = spans or []
                if told:
                    told, base = set(told), [(s["kind"], s["start"], s["stop"]) for s in spans]
                    extra = [(a, b) for t, a, b in _words(text, base) if t in told]
                    spans = spans + [{"kind": "term", "start": a, "stop": b, "value": text[a:b]} for a, b in extra]
                    spans.sort(key=lambda s: (s["start"], KINDS.index(s["kind"])))
                spans_out.append(spans)
                if not spans:
                    texts.append(None if only_private else text)
                    continue
                parts, at = [], 0
                for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
                    if s["start"] < at:
                        # an overlapping span: what it has beyond the last one goes too
                        at = max(at, s["stop"])
                        continue
                    parts.append(text[at : s["start"]])
                    own = text[s["start"] : s["stop"]]
                    general = re.sub(r"[^\W\d_]", "x", re.sub("[0-9]", "0", own))
                    parts.append(general if s["kind"] == "term" else f"[{s['kind'].upper()}]")
                    at = s["stop"]
                texts.append("".join([*parts, text[at:]]))
            columns = [pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans_out, _SPANS_ARROW)], [*names, spans_col])

    return run


def sanitise(
    docs: DataFrame,
    text_col: str = "text",
    spans_col: str = "spans",
    context: int = CONTEXT,
    least_docs: int = LEAST_DOCS,
    disclosure: float = DISCLOSURE,
    only_private: bool = False,
) -> DataFrame:
    """``docs`` with sanitised texts and an array of the spans found in the originals.

    ``only_private=True`` nulls the texts without any span, for callers that want
    the spans alone.
    """
    told = disclosures(docs, text_col, context, least_docs, disclosure)
    told = store(told.select("term").distinct(), "disclosures")
    sent = docs.sparkSession.sparkContext.broadcast(_filter_bits(told))
    kept = [f for f in docs.schema.fields if f.name != spans_col]
    names = [f.name for f in kept]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{spans_col}` {SPANS}"])
    row, hit, told_col = free_name(docs, "row"), free_name(docs, "hit"), free_name(docs, "told")
    found = docs.mapInArrow(_found(names, text_col, spans_col, hit, sent, only_private), f"{schema}, `{hit}` array<string>")
    found = store(found.withColumn(row, F.monotonically_increasing_id()), "spans")
    pairs = found.select(row, F.explode(hit).alias("term")).join(told, "term")
    pairs = pairs.groupBy(row).agg(F.collect_list("term").alias(told_col))
    joined = found.drop(hit).join(pairs, row, "left").drop(row)
    return joined.mapInArrow(_applied(names, text_col, spans_col, told_col, only_private), schema)


def listed(spans: Column, base: bool = False) -> Column:
    """kind:start:end, comma-joined; ``base`` leaves out the method's own spans."""
    own = F.filter(spans, lambda s: s["kind"] != "term") if base else spans
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
