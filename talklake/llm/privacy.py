"""Personal data: base patterns, and terms whose co-occurrence with a protected entity discloses it."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from talklake.llm.common import by_slices, extended, free_name, without, written

KINDS = ("email", "ip", "card", "phone", "term")
#: A term discloses an entity when it carries this share of the entity's information.
DISCLOSURE = 0.8
#: Documents that must show a term together with an entity; a single one says nothing about either.
SUPPORT = 2
#: Terms counted in a worker before they are passed on.
TERMS_PER_FLUSH = 200_000
#: Bits of a map that tells workers which terms, or documents, cannot be among those in question, whatever their number.
MAP_BITS = 1 << 25

EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
# A match takes all digits of its first run, so none begins after another digit.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]{3,}")
#: All bytes but lower-case ASCII letters and digits become blanks.
ASCII_WORDS = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))

SPAN = "struct<kind:string,start:int,end:int>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the run of address characters before it, which ends where the last match did."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_CHARS:
            start -= 1
        tail = EMAIL_TAIL.match(text, at) if start < at else None
        if tail:
            yield start, tail.end()
            done = tail.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Kind, first character and end of every base match, by start and kind."""
    if not text:
        return []
    found = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def entity_key(kind: str, value: str) -> str:
    """One key for the spellings of an entity."""
    return f"{kind}:{value.lower() if kind == 'email' else re.sub(r'[^0-9.]' if kind == 'ip' else r'[^0-9]', '', value)}"


def free_words(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """The words outside all base matches; ``spans`` come by their start."""
    merged: list[list[int]] = []
    for _, a, b in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    i = 0
    for m in WORD.finditer(text):
        a, b = m.span()
        while i < len(merged) and merged[i][1] <= a:
            i += 1
        if i == len(merged) or b <= merged[i][0]:
            yield a, b


def lowered(text: str) -> str | None:
    """The text in lower case, where that is every character by itself and in its place; else None.

    Only a capital sigma, which is lowered by what is around it, and a capital I with a dot, which becomes two
    characters, are different.
    """
    return None if "\u03a3" in text or "\u0130" in text else text.lower()


def terms_of(text: str | None, spans: list[tuple[str, int, int]]) -> set[str]:
    """The distinct terms of a text, outside its base matches."""
    if not text:
        return set()
    if spans or (low := lowered(text)) is None:
        return {w.lower() for w in {text[a:b] for a, b in free_words(text, spans)}}
    if low.isascii():
        return {w for w in set(low.encode().translate(ASCII_WORDS).decode().split()) if len(w) > 2}
    return set(WORD.findall(low))


def on_map(bits: bytes, values: Iterable[str]) -> set[str]:
    """The values that a map of ``_map_of`` does not rule out."""
    checksum, mask = zlib.crc32, MAP_BITS - 1
    return {v for v in values if bits[(p := checksum(v.encode()) & mask) >> 3] >> (p & 7) & 1}


def document_frequency(docs: DataFrame, text: str = "text", among: bytes | None = None) -> DataFrame:
    """In how many documents each term occurs outside base matches, over all documents: ``term, n``.

    Workers sum the counts of many documents before anything is shuffled. With ``among``, a map of terms, those that
    it rules out are not counted.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["term", "n"]
            )
            total.clear()
            return out

        for batch in batches:
            for value in batch.column(0):
                whole = value.as_py()
                terms = terms_of(whole, base_spans(whole))
                total.update(terms if among is None else on_map(among, terms))
                if len(total) > TERMS_PER_FLUSH:
                    yield flush()
        if total:
            yield flush()

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "term string, n bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def _discloses(total: int, disclosure: float) -> Column:
    """Whether the counts ``n_e``, ``n`` and ``n_et`` of ``total`` documents reach the threshold."""
    bits = F.log2(F.lit(float(total)) * F.col("n_et") / (F.col("n_e") * F.col("n")))
    whole = F.log2(F.lit(float(total)) / F.col("n_e"))
    # An entity in every document has nothing left to disclose.
    return (whole > 0) & (bits >= disclosure * whole)


def _entities(docs: DataFrame) -> DataFrame:
    """``doc, entities, terms`` of the documents with a base match, from ``doc, text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for doc, value in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if spans := base_spans(value):
                out.append((doc, sorted({entity_key(k, value[a:b]) for k, a, b in spans}), sorted(terms_of(value, spans))))
        if not out:
            return None
        strings = pa.list_(pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), strings, strings), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["doc", "entities", "terms"])

    return docs.mapInArrow(by_slices(work, "text"), "doc string, entities array<string>, terms array<string>")


def marked_terms(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """The distinct terms that disclose any entity, from ``doc, text``: ``term``.

    With ``N`` documents, an entity in ``n_e``, a term in ``n_t`` and the two together in ``n_et`` of them, wherever they
    are, a term gives away ``log2(N n_et / (n_e n_t))`` bits of the entity's ``log2(N / n_e)``. At full disclosure every
    document with the term has the entity. Every row counts, repeated ones too. ``doc`` is the same for equal texts alone.

    Copies are summed up before entities meet terms, and entities in the very same documents meet them as one.
    """
    found = written(_entities(docs), "mentions")
    texts = found.groupBy("doc").agg(
        F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms")
    )
    texts = written(texts, "mentioned")
    # The sum of its documents' hashes stands for the set of them.
    share = F.xxhash64("doc").cast("decimal(38,0)") * F.col("copies")
    seen = texts.select("doc", "copies", share.alias("share"), F.explode("entities").alias("entity"))
    sets = seen.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.sum("share").alias("same"))
    sets = written(sets.where(F.col("n_e") >= support), "entities")
    groups = seen.select("doc", "entity").join(sets, "entity").select("doc", "n_e", "same").distinct()
    together = (
        groups.join(texts.select("doc", "copies", "terms"), "doc")
        .select("n_e", "same", "copies", F.explode("terms").alias("term"))
        .groupBy("n_e", "same", "term")
        .agg(F.sum("copies").alias("n_et"))
        .where(F.col("n_et") >= support)
    )
    # A group's set is of no further use: of equal counts one is enough.
    candidates = written(together.select("n_e", "n_et", "term").distinct(), "candidates")
    frequency = document_frequency(docs, among=_map_of(candidates, "term"))
    discloses = _discloses(docs.count(), disclosure)
    return written(candidates.join(frequency, "term").where(discloses).select("term").distinct(), "terms")


def _map_of(rows: DataFrame, name: str) -> bytes:
    """A bit for the checksum of each value of a column: of fixed size, and only good for telling that one is not there."""
    place = F.crc32(F.col(f"`{name}`").cast("binary")).bitwiseAND(F.lit(MAP_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = rows.select(F.shiftright(place, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    told = words.toArrow()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[told["at"].to_numpy()] = told["bits"].to_numpy()
    return out.tobytes()


def _everywhere(kept: DataFrame, text: str, disclosure: float, support: int) -> DataFrame:
    """``kept`` with ``spans``: base matches, and every occurrence of a disclosing term in any document.

    A document's distinct terms are joined with the disclosing ones; only those that a map lets through are
    shuffled. So are the texts of the documents that another map says may have marks; all others get their base matches
    where they are, and no text is cut into words again.
    """
    own = F.col(f"`{text}`")
    doc = F.concat_ws("-", *(F.xxhash64(F.lit(seed), own) for seed in ("left", "right")))
    plain = kept.select(doc.alias("doc"), own.alias("text"))
    terms = marked_terms(plain, disclosure, support)
    bits = _map_of(terms, "term")

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = [
            (d, t)
            for d, value in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for t in on_map(bits, terms_of(value, base_spans(value)))
        ]
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["doc", "term"])

    met = plain.mapInArrow(by_slices(pairs, "text"), "doc string, term string").dropDuplicates(["doc", "term"])
    row, told = (free_name(kept, name) for name in ("__doc", "__marks"))
    marks = met.join(terms, "term").groupBy(F.col("doc").alias(row)).agg(F.collect_list("term").alias(told))
    marks = written(marks, "marks")
    marked = _map_of(marks, row)
    schema, own_names = extended(kept.schema, f"spans array<{SPAN}>"), list(kept.columns)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    keyed = kept.withColumn(row, doc)

    def spanned(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text).to_pylist()
        known = batch.column(told).to_pylist() if told in batch.schema.names else [None] * len(texts)
        out = [
            [dict(zip(("kind", "start", "end"), s, strict=True)) for s in all_spans(value, set(m or ()))]
            for value, m in zip(texts, known, strict=True)
        ]
        columns = [batch.column(n) for n in own_names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(out, span_type)], names=[*own_names, "spans"])

    def having(batch: pa.RecordBatch, marks: bool) -> pa.RecordBatch | None:
        keys = batch.column(row).to_pylist()
        there = on_map(marked, keys)
        mine = [i for i, key in enumerate(keys) if (key in there) == marks]
        return batch.take(pa.array(mine, pa.int64())) if mine else None

    def unmarked(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rest = having(batch, False)
        return None if rest is None else spanned(rest)

    # Each row is on one side of the map: the text decides.
    hit = keyed.mapInArrow(by_slices(lambda batch: having(batch, True), text), keyed.schema).join(marks, row, "left").drop(row)
    return keyed.mapInArrow(by_slices(unmarked, text), schema).unionByName(hit.mapInArrow(by_slices(spanned, text), schema))


def all_spans(text: str | None, marked: set[str]) -> list[tuple[str, int, int]]:
    """Base matches and the occurrences of marked terms, by start and kind."""
    base = base_spans(text)
    if not marked:
        return base
    if base or (low := lowered(text)) is None:
        terms = [("term", a, b) for a, b in free_words(text, base) if text[a:b].lower() in marked]
        return sorted([*base, *terms], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [("term", *m.span()) for m in WORD.finditer(low) if m.group() in marked]


def personal_data(
    docs: DataFrame,
    text: str = "text",
    disclosure: float = DISCLOSURE,
    support: int = SUPPORT,
) -> DataFrame:
    """The columns of ``docs`` with ``spans``: the base matches and the disclosing terms, in order.

    Base matches are e-mail addresses, network addresses, cards and phone numbers. Their distinct values are the
    protected entities. A term that discloses an entity it shares documents with is marked wherever it occurs, in
    every document.

    Null and empty texts have no spans. Repeated rows are documents of their own. A column of ``docs``
    named ``spans`` is replaced.
    """
    return _everywhere(without(docs, "spans"), text, disclosure, support)


def sanitised(found: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each marked stretch replaced by its kind in brackets, and without ``spans``.

    Base matches are generalised to their kind, terms to ``[TERM]``. Spans that overlap are replaced
    together, by the kind of the first.
    """
    schema = type(found.schema)([f for f in found.schema.fields if f.name != "spans"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for value, spans in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist(), strict=True):
            out.append(replaced(value, spans) if spans else value)
        columns = [pa.array(out, pa.string()) if f.name == text else batch.column(f.name) for f in schema.fields]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return found.mapInArrow(by_slices(work, text), schema)


def replaced(text: str, spans: list[dict]) -> str:
    parts, at = [], 0
    i = 0
    while i < len(spans):
        start, end, kind = spans[i]["start"], spans[i]["end"], spans[i]["kind"]
        while i + 1 < len(spans) and spans[i + 1]["start"] < end:
            i += 1
            end = max(end, spans[i]["end"])
        parts += [text[at:start], f"[{kind.upper()}]"]
        at, i = end, i + 1
    return "".join([*parts, text[at:]])


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: matches of each kind, the digest of the base spans, and all spans."""
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        *(count(k) for k in KINDS),
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
