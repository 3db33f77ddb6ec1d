"""Byte-level BPE: DuckDB contracts the pairs of each distinct word by a recursive query."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from talklake.llm.common import by_slices, extended, ragged_take, trim, without, worker_state

#: Most bytes of a vocabulary file; it travels to every worker.
VOCABULARY_BYTES = 16 << 20
#: Memory of a worker's DuckDB. It writes nothing to disk; words that need more are taken in two halves.
DUCKDB_MEMORY = "96MB"
#: Words of one recursive query.
WORDS_PER_QUERY = 20_000
#: Words of more bytes are contracted by the keyed recursion. The plain one is faster on short words but keeps a
#: row per byte and step, the square of a word's length.
KEYED_FROM = 96
#: Bytes of known words and runs a worker keeps, with their ids; when there are more, it starts afresh.
KNOWN_BYTES = 32 << 20
#: Bytes of text encoded in one go: new words of several texts share a query.
SLICE = 2 << 20
#: Patterns that end a word before every blank with another character after it, so that a text may be cut there
#: before it is matched. Texts of other patterns are matched as a whole. Fixed value: the pattern of the given vocabulary.
CUT_AT_BLANKS = frozenset([r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"])

#: A row is a token: its first byte's place (word * 256 + byte), its length and its id. One step joins each
#: token with the one that begins where it ends and with the merge table, and contracts each word's pair of
#: least rank, the leftmost of equals; id, place and both lengths of a pair are one number, so that its least is
#: found by one aggregate. A word without a pair passes on its tokens once more, as done.
CONTRACT = """
WITH RECURSIVE step(place, len, tok, done) AS (
  SELECT place, len, tok, false FROM start
  UNION ALL
  SELECT s.place,
    CASE WHEN s.place = (b.best >> 16) & 134217727 THEN ((b.best >> 8) & 255) + (b.best & 255) ELSE s.len END::INTEGER,
    CASE WHEN s.place = (b.best >> 16) & 134217727 THEN b.best >> 43 ELSE s.tok END::INTEGER,
    b.best IS NULL
  FROM step s LEFT JOIN (
    SELECT l.place >> 8 AS word, min((m.id::BIGINT << 43) + (l.place << 16) + (l.len << 8) + r.len) AS best
    FROM step l JOIN step r ON r.place = l.place + l.len JOIN merges m ON m.pair = (l.tok::BIGINT << 20) + r.tok
    WHERE NOT l.done GROUP BY 1) b ON b.word = s.place >> 8
  WHERE NOT s.done AND (b.best IS NULL OR s.place <> ((b.best >> 16) & 134217727) + ((b.best >> 8) & 255)))
SELECT place >> 8 AS word, tok FROM step WHERE done ORDER BY place
"""

#: The same, keyed by place (word * 2**32 + byte): a step overwrites the tokens it changes, so there is one row per
#: byte however long a word is. A step contracts all places of the word's least rank, in chains of overlapping ones
#: every other: a merge never makes a pair of lower rank than its own, as every token encodes to itself.
CONTRACT_KEYED = """
WITH RECURSIVE step(place, len, tok) USING KEY (place) AS (
  SELECT place, len, tok FROM start
  UNION
  SELECT unnest([place, gone]), unnest([total, 0]), unnest([id, -1]) FROM (
    SELECT *, row_number() OVER (PARTITION BY word, chain ORDER BY place) AS turn FROM (
      SELECT *, sum(CASE WHEN before = place THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY place) AS chain FROM (
        SELECT *, lag(gone) OVER (PARTITION BY word ORDER BY place) AS before FROM (
          SELECT *, min(id) OVER (PARTITION BY word) AS least FROM (
            SELECT l.place >> 32 AS word, l.place, r.place AS gone, l.len + r.len AS total, m.id
            FROM (SELECT DISTINCT place >> 32 AS word FROM step) a
            JOIN recurring.step l ON l.place >> 32 = a.word JOIN recurring.step r ON r.place = l.place + l.len
            JOIN merges m ON m.pair = (l.tok::BIGINT << 20) + r.tok WHERE l.len > 0 AND r.len > 0))
        WHERE id = least)))
  WHERE turn % 2 = 1)
SELECT place >> 32 AS word, tok FROM step WHERE len > 0 ORDER BY place
"""

#: Token texts in order, each byte as the character of that number.
JOIN_UP = """
SELECT word, string_agg(v.chars, '' ORDER BY t.pos) AS chars
FROM tokens t JOIN vocabulary v ON v.id = t.tok GROUP BY word ORDER BY word
"""


def read_vocabulary(path: str) -> bytes:
    """The file of base64 tokens and ranks, read by the driver."""
    with open(path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary may have {VOCABULARY_BYTES} bytes")
    return content


def parse_vocabulary(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


class Lists:
    """Lists of numbers, one after the other, to which more are added."""

    def __init__(self, kind: type) -> None:
        self.offsets, self.values = np.zeros(1, np.int64), np.zeros(0, kind)

    def add(self, sizes: np.ndarray, values: np.ndarray) -> None:
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        self.values = np.concatenate([self.values, values.astype(self.values.dtype, copy=False)])


class Codec:
    """Encodes and decodes words; lives in one worker."""

    def __init__(self, content: bytes, pattern: str) -> None:
        import duckdb
        import regex

        self.ranks = parse_vocabulary(content)
        self.pattern = regex.compile(pattern)
        self.cut = pattern in CUT_AT_BLANKS
        self.double_blank, self.inner_blank = regex.compile(r"\s\s"), regex.compile(r"(?<=\S) (?=\S)")
        self.out_of_memory = duckdb.OutOfMemoryException
        self.db = duckdb.connect(
            ":memory:",
            config={
                "threads": 1,
                "memory_limit": DUCKDB_MEMORY,
                "preserve_insertion_order": False,
                "temp_directory": "",
            },
        )
        tokens = list(self.ranks)
        vocabulary = pa.table(
            {"id": pa.array([self.ranks[t] for t in tokens], pa.int32()), "chars": [t.decode("latin-1") for t in tokens]}
        )
        pairs = [
            ((self.ranks[token[:i]] << 20) + self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        merges = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "id": pa.array([r for _, r in pairs], pa.int32())})
        for name, data in (("vocabulary", vocabulary), ("merges", merges)):
            self.db.register("given", data)
            self.db.execute(f"CREATE TABLE {name} AS FROM given")
            self.db.unregister("given")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        #: Known words and runs of words, and by their places the ids and the bytes they decode to. Arrow
        #: finds places by hashing anew, which is cheap next to a dictionary's objects.
        self.known = pa.array([], pa.string())
        self.ids, self.texts = Lists(np.int32), Lists(np.uint8)

    def held(self) -> int:
        return self.known.nbytes + sum(x.offsets.nbytes + x.values.nbytes for x in (self.ids, self.texts))

    def places(self, names: pa.Array) -> np.ndarray:
        """Where names are known, -1 if they are not."""
        return pc.index_in(names, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)

    def learn(self, runs: pa.Array) -> None:
        """Make new distinct runs known, through their distinct words."""
        split = [self.words(run) for run in runs.to_pylist()]
        flat = pa.array([w for found in split for w in found], pa.string())
        counts = np.array([len(found) for found in split], np.int64)
        words = flat.filter(pa.array(self.places(flat) < 0)).unique().to_pylist()
        raws = [w.encode() for w in words]
        whole = np.fromiter((self.ranks.get(raw, -1) for raw in raws), np.int64, len(raws))
        single = np.flatnonzero(whole >= 0)
        order, sizes, ids = [single.tolist()], [np.ones(len(single), np.int64)], [whole[single]]
        unknown = np.flatnonzero(whole < 0).tolist()
        short, long = ([i for i in unknown if (len(raws[i]) > KEYED_FROM) == keyed] for keyed in (False, True))
        for todo, sql, shift in ((short, CONTRACT, 8), (long, CONTRACT_KEYED, 32)):
            for start in range(0, len(todo), WORDS_PER_QUERY):
                order.append(todo[start : start + WORDS_PER_QUERY])
                size, found = self.contract([raws[i] for i in order[-1]], sql, shift)
                sizes.append(size)
                ids.append(found)
        sizes, ids = np.concatenate(sizes), np.concatenate(ids)
        self.texts.add(*self.decode(sizes, ids))
        self.ids.add(sizes, ids)
        # Places are given in the order in which the words were contracted.
        self.known = pa.concat_arrays([self.known, pa.array([words[i] for part in order for i in part], pa.string())])
        several = counts != 1
        places = self.places(flat.filter(pa.array(np.repeat(several, counts))))
        cuts = np.concatenate(([0], np.cumsum(counts[several])))
        for store in (self.ids, self.texts):
            ends, values = ragged_take(store.offsets, store.values, places)
            store.add(np.diff(ends[cuts]), values)
        self.known = pa.concat_arrays([self.known, runs.filter(pa.array(several))])

    def contract(self, raws: list[bytes], sql: str, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and the ids, of words of two bytes or more."""
        sizes = np.array([len(r) for r in raws])
        places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = pa.table(
            {
                "place": pa.array((np.repeat(np.arange(len(raws), dtype=np.int64), sizes) << shift) + places),
                "len": pa.array(np.ones(len(places), np.int32)),
                "tok": pa.array(self.byte_ids[np.frombuffer(b"".join(raws), np.uint8)]),
            }
        )
        self.db.register("start", rows)
        try:
            found = self.db.execute(sql).fetchnumpy()
        except self.out_of_memory:
            if len(raws) == 1:
                raise
            half = len(raws) // 2
            halves = self.contract(raws[:half], sql, shift), self.contract(raws[half:], sql, shift)
            return np.concatenate([h[0] for h in halves]), np.concatenate([h[1] for h in halves])
        finally:
            self.db.unregister("start")
        return np.bincount(found["word"], minlength=len(raws)), np.asarray(found["tok"], np.int32)

    def encode(self, texts: Sequence[str]) -> tuple[Lists, Lists]:
        """Ids of whole texts, each match of the pattern by itself, and the bytes they decode to."""
        if self.held() > KNOWN_BYTES:
            self.forget()
        flat: list[str] = []
        ends = [0]
        for text in texts:
            flat += self.runs(text)
            ends.append(len(flat))
        column = pa.array(flat, pa.string())
        del flat
        numbers = self.places(column)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            missing = column.take(pa.array(new))
            self.learn(missing.unique())
            numbers[new] = self.places(missing)
        out = []
        for store in (self.ids, self.texts):
            offsets, values = ragged_take(store.offsets, store.values, numbers)
            found = Lists(values.dtype.type)
            found.offsets, found.values = offsets[np.array(ends)], values
            out.append(found)
        if len(new):
            trim()
        return out[0], out[1]

    def words(self, run: str) -> list[str]:
        """The matches of the pattern. Letters after a blank are one match of a pattern that may be cut at blanks."""
        if self.cut and (run[1:] if run[0] == " " else run).isalpha():
            return [run]
        return self.pattern.findall(run)

    def runs(self, text: str) -> list[str]:
        """The text, cut before single blanks between other characters where the pattern allows it."""
        if not text:
            return []
        if not self.cut:
            return [text]
        if text[0].isspace() or text[-1].isspace() or self.double_blank.search(text):
            parts = self.inner_blank.split(text)
        else:
            parts = text.split(" ")
        return [parts[0], *[" " + p for p in parts[1:]]]

    def decode(self, sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and bytes of what lists of ids stand for, by an ordered aggregation."""
        # Long lists go in pieces, which are put together again below.
        piece, most = 64, 8 * WORDS_PER_QUERY
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        counts = -(-sizes // piece)
        part = (np.cumsum(counts) - counts)[owner] + place // piece
        lengths, texts = np.zeros(len(sizes), np.int64), []
        piece_owner = np.repeat(np.arange(len(sizes)), counts)
        start = 0
        while start < len(ids):
            stop = int(np.searchsorted(part, part[min(start + most, len(ids)) - 1], side="right"))
            rows = {"word": part[start:stop], "pos": (place % piece)[start:stop].astype(np.int32), "tok": ids[start:stop].astype(np.int32)}
            self.db.register("tokens", pa.table({k: pa.array(v) for k, v in rows.items()}))
            found = self.db.execute(JOIN_UP).fetchnumpy()
            self.db.unregister("tokens")
            chars = found["chars"].tolist()
            np.add.at(lengths, piece_owner[found["word"]], [len(x) for x in chars])
            texts.append("".join(chars).encode("latin-1"))
            start = stop
        return lengths, np.frombuffer(b"".join(texts), np.uint8)


def _codec(content: bytes, pattern: str) -> Codec:
    """This worker's codec for a vocabulary; it and what it knows outlive a task where workers are reused."""
    state = worker_state(f"bpe {hashlib.sha256(content).hexdigest()} {pattern}")
    if "codec" not in state:
        state["codec"] = Codec(content, pattern)
    return state["codec"]


def _shared(spark: SparkSession, path: str) -> Broadcast[bytes]:
    return spark.sparkContext.broadcast(read_vocabulary(path))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """The columns of ``docs`` with the ids of the whole text; null and empty texts have none.

    A worker encodes each distinct word once and remembers it, up to ``KNOWN_WORDS`` words. No row is
    shuffled. A column of ``docs`` with the result's name is replaced.
    """
    kept = without(docs, name)
    schema = extended(kept.schema, f"`{name}` array<int>")
    vocabulary = _shared(docs.sparkSession, path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, _ = _codec(vocabulary.value, pattern).encode([t or "" for t in batch.column(text).to_pylist()])
        lists = pa.ListArray.from_arrays(pa.array(found.offsets.astype(np.int32)), pa.array(found.values))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], names=[f.name for f in schema.fields])

    return kept.mapInArrow(by_slices(work, text, SLICE, "bpe"), schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The columns of ``rows`` with the bytes the ids stand for; null ids give none.

    Bytes need not be whole UTF-8 characters, so the result is binary.
    """
    kept = without(rows, name)
    schema = extended(kept.schema, f"`{name}` binary")
    vocabulary = _shared(rows.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codec = _codec(vocabulary.value, r"\s+")
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                values = [np.array(x or [], np.int32) for x in part.column(ids).to_pylist()]
                sizes = np.array([len(v) for v in values], np.int64)
                lengths, texts = codec.decode(sizes, np.concatenate(values))
                ends = np.concatenate(([0], np.cumsum(lengths)))
                found = pa.array([texts[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without the text, with ``n_tokens, ids_sha256, decoded_sha256``.

    Encodes whole texts and decodes the ids in the same pass, so that neither travels. The ids digest is
    of little-endian unsigned 32-bit numbers. Columns of ``docs`` named like the results are replaced.
    """
    kept = without(docs, "n_tokens", "ids_sha256", "decoded_sha256")
    out = [f for f in kept.schema.fields if f.name != text]
    schema = extended(type(kept.schema)(out), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    vocabulary = _shared(docs.sparkSession, path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = _codec(vocabulary.value, pattern).encode([t or "" for t in batch.column(text).to_pylist()])
        cuts = lambda lists: zip(lists.offsets.tolist(), lists.offsets[1:].tolist(), strict=False)
        little = Lists(np.uint32)
        little.offsets, little.values = ids.offsets, ids.values.astype("<u4")
        columns = [batch.column(f.name) for f in out]
        columns += [
            pa.array(np.diff(ids.offsets), pa.int64()),
            *(pa.array([hashlib.sha256(x.values[a:b]).hexdigest() for a, b in cuts(x)], pa.string()) for x in (little, texts)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return kept.mapInArrow(by_slices(work, text, SLICE, "bpe"), schema)
