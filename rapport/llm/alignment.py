"""Aligning the tokens of two tokenizers over the same bytes, and counting what meets.

Both token sequences of a text end at places in its bytes. Places where a token of each
ends cut the text into groups. They are found by divide and conquer: in an interval a common
end near the middle is looked for by bisecting one list of ends for an end of the other, by
turns, first to the right and then to the left; both halves go on the same way. An interval
without a common end inside is a group. Intervals of many texts are halved side by side.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import chunks, small_batches, text_bytes
from rapport.llm.pieces import KEPT_LETTERS, SPACE, Encoder, Kept, Vocabulary, words
from rapport.operators.joins import split_join
from rapport.sources.sinks import stored

# Bytes of text aligned side by side.
SIDE_BY_SIDE = 1 << 19
# A block of documents ends at so many bytes of text or distinct linked pairs.
BLOCK_BYTES = 16 << 20
BLOCK_PAIRS = 500_000
# Pairs of a block in a row, at most.
ROW_PAIRS = 8192
# Groups with more links than this are reduced to distinct ids before they are multiplied.
WIDE = 4096
# Ids of either tokenizer lie below this.
IDS = 1 << 20
# Signs that are neither letters nor digits nor white space, and the last of the Latin letters.
SIGNS, LATIN = ",.;:!?", "\u024f"
# White space in any sense, and the blank of pieces: behind one of these a blank may go on with what stands before.
OPEN = frozenset([c for c in map(chr, range(0x3001)) if c.isspace()] + ["\u180e", "\u200b", "\ufeff", SPACE])


def byte_letters() -> dict[str, int]:
    """Byte that each letter of a byte-level vocabulary stands for: visible ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Units:
    """Ids of both tokenizers for words with the blank before them.

    A blank after a letter or sign starts a new unit: neither the pattern of the byte-level
    tokenizer nor a piece goes on over it, so units are encoded one by one and kept.
    """

    def __init__(self, byte_model: str, vocabulary: Vocabulary):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(byte_model)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        letters = byte_letters()
        self.letter_of = {byte: letter for letter, byte in letters.items()}
        ids = self.tokenizer.get_vocab()
        self.size_a = np.zeros(max(ids.values()) + 1, np.int64)
        for piece, i in ids.items():
            self.size_a[i] = len(bytes(letters[c] for c in piece))
        self.pieces = Encoder(vocabulary)
        self.size_b = np.array([len(r) for r in self.pieces.raw], np.int64)
        self.known = Kept()

    def unit(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of a blank and a text; nothing if the bytes of either side differ from it.

        Bytes of the byte-level side are always the text's. Pieces give back all but their own
        sign for a blank, which they give back as a blank.
        """
        if SPACE in text:
            return None
        return array("i", self.byte_ids(text)).tobytes(), self.pieces.unit(SPACE + text.replace(" ", SPACE)).tobytes()

    def byte_ids(self, text: str) -> list[int]:
        """Ids of a blank and a text by the byte-level tokenizer.

        Its pattern keeps a blank and plain letters together, and the signs behind them: such
        words go to its model as these two parts.
        """
        core = text.rstrip(SIGNS)
        if not core.isalpha() or not core.isascii() and max(core) > LATIN:
            return self.tokenizer.encode(" " + text, add_special_tokens=False).ids
        parts = [" " + core, text[len(core) :]] if len(core) < len(text) else [" " + core]
        return [t.id for p in parts for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.letter_of))]

    def of(self, text: str) -> tuple[bytes, bytes]:
        """Ids of both tokenizers, as 32-bit numbers; none if the bytes of a side differ from the text's."""
        none = (b"", b"")
        if not text:
            return none
        found, front, known = [], [], self.known
        for word in words(text):
            ids = known.get(word) or known.find(word)
            if ids is None or front:
                if not word or word[-1] in OPEN:
                    front.append(word)
                    continue
                if front:
                    front.append(word)
                    word, front = " ".join(front), []
                ids = self.unit(word)
                if ids is None:
                    return none
                if len(word) <= KEPT_LETTERS:
                    known.keep(word, ids)
            found.append(ids)
        if front:
            ids = self.unit(" ".join(front))
            if ids is None:
                return none
            found.append(ids)
        return b"".join([a for a, _ in found]), b"".join([b for _, b in found])


def groups(ends_a: np.ndarray, ends_b: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end: places behind their last token of either side, in rising order.

    ``spans`` has a row (first and behind-last token of a, the same of b) for each interval to
    start with; both sides of an interval start and end at the same bytes.
    """
    found = []
    i0, i1, j0, j1 = (spans[:, k] for k in range(4))
    while len(i0):
        # An interval of one token has no end inside.
        leaf = (i1 - i0 <= 1) | (j1 - j0 <= 1)
        found.append(np.stack((i1[leaf], j1[leaf])))
        i0, i1, j0, j1 = (x[~leaf] for x in (i0, i1, j0, j1))
        if not len(i0):
            break
        middle = i0 + (i1 - i0) // 2 - 1
        # To the right: the end of the interval is common, so this stops there at the latest.
        at, to = middle.copy(), np.empty_like(middle)
        left = np.arange(len(at))
        while len(left):
            end = ends_a[at[left]]
            j = np.searchsorted(ends_b, end)
            to[left] = j
            apart = ends_b[j] != end
            left, j = left[apart], j[apart]
            at[left] = np.searchsorted(ends_a, ends_b[j])
        right = at < i1 - 1
        # To the left, where nothing was found; before the first token there is no end.
        left = np.flatnonzero(~right)
        at[left] = middle[left]
        while len(left):
            end = ends_a[at[left]]
            j = np.searchsorted(ends_b, end, side="right") - 1
            to[left] = j
            inside = j >= j0[left]
            at[left[~inside]] = -1
            left, j, end = left[inside], j[inside], end[inside]
            apart = ends_b[j] != end
            left, j = left[apart], j[apart]
            i = np.searchsorted(ends_a, ends_b[j], side="right") - 1
            inside = i >= i0[left]
            at[left] = np.where(inside, i, -1)
            left = left[inside]
        cut = at >= 0
        found.append(np.stack((i1[~cut], j1[~cut])))
        # Behind a cut to the left of the middle nothing is left to find.
        done = cut & ~right
        found.append(np.stack((i1[done], j1[done])))
        more = right
        i0, i1, j0, j1 = (
            np.concatenate((i0[cut], at[more] + 1)),
            np.concatenate((at[cut] + 1, i1[more])),
            np.concatenate((j0[cut], to[more] + 1)),
            np.concatenate((to[cut] + 1, j1[more])),
        )
    both = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    return np.sort(both[0]), np.sort(both[1])


def digits(many: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``many`` and a place for a sign, and which of these are used."""
    width = len(str(many - 1))
    numbers = np.arange(many)
    powers = 10 ** np.arange(width - 1, -1, -1)
    text = np.zeros((many, width + 1), np.uint8)
    text[:, :width] = numbers[:, None] // powers % 10 + 48
    used = np.ones((many, width + 1), bool)
    used[:, : width - 1] = numbers[:, None] >= powers[:-1]
    return text, used


class Models:
    """Both models as they go to the tasks; a worker builds its units once and keeps them for later tasks."""

    def __init__(self, byte_model: str, vocabulary: Vocabulary):
        self.parts = byte_model, vocabulary

    @cached_property
    def units(self) -> Units:
        return Units(*self.parts)


class Chunk:
    """Some texts aligned side by side. Token places count over all of them."""

    def __init__(self, units: Units, texts: list[str]):
        both = [units.of(t) for t in texts]
        self.a = np.frombuffer(b"".join(a for a, _ in both), np.int32).astype(np.int64)
        self.b = np.frombuffer(b"".join(b for _, b in both), np.int32).astype(np.int64)
        # Behind the last token and group of each text, from 0 on.
        self.of_a = np.cumsum([0, *(len(a) // 4 for a, _ in both)])
        self.of_b = np.cumsum([0, *(len(b) // 4 for _, b in both)])
        spans = np.stack((self.of_a[:-1], self.of_a[1:], self.of_b[:-1], self.of_b[1:]), axis=1)
        spans = spans[spans[:, 0] < spans[:, 1]]
        ends_a, ends_b = np.cumsum(units.size_a[self.a]), np.cumsum(units.size_b[self.b])
        self.to_a, self.to_b = groups(ends_a, ends_b, spans)
        self.of_group = np.searchsorted(self.to_a, self.of_a, side="right")
        self.many_a, self.many_b = np.diff(self.to_a, prepend=0), np.diff(self.to_b, prepend=0)
        self.links = self.many_a * self.many_b

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of the values of groups, by text."""
        return np.diff(np.concatenate(([0], np.cumsum(values)))[self.of_group])

    def written(self, text: np.ndarray, used: np.ndarray) -> list[bytes]:
        """Groups of each text as `a1,a2|b1;a3|b2,b3`; ``text`` and ``used`` are those of ``digits``."""
        group_a = np.repeat(np.arange(len(self.to_a)), self.many_a)
        group_b = np.repeat(np.arange(len(self.to_b)), self.many_b)
        place_a = np.arange(len(self.a)) + (self.to_b - self.many_b)[group_a]
        place_b = np.arange(len(self.b)) + self.to_a[group_b]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        signs = np.full(len(ids), ord(","), np.uint8)
        signs[place_a[self.to_a - 1]] = ord("|")
        signs[place_b[self.to_b - 1]] = ord(";")
        rows = text[ids]
        rows[:, -1] = signs
        keep = used[ids]
        flat = rows[keep]
        ends = np.concatenate(([0], np.cumsum(keep.sum(axis=1))))[self.of_a + self.of_b]
        return [flat[s : max(s, e - 1)].tobytes() for s, e in zip(ends[:-1], ends[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs of each text: text, id of a, id of b, number of links; sorted by the first three."""
        owner = np.repeat(np.arange(len(self.of_group) - 1), np.diff(self.of_group))
        start_a, start_b = self.to_a - self.many_a, self.to_b - self.many_b
        small = np.flatnonzero(self.links <= WIDE)
        many = self.links[small]
        group = np.repeat(small, many)
        place = np.arange(len(group)) - np.repeat(np.cumsum(many) - many, many)
        across = self.many_b[group]
        keys = (owner[group] * IDS + self.a[start_a[group] + place // across]) * IDS + self.b[start_b[group] + place % across]
        keys, times = np.unique(keys, return_counts=True)
        more_keys, more_times = [keys], [times]
        for g in np.flatnonzero(self.links > WIDE).tolist():
            ids_a, n_a = np.unique(self.a[start_a[g] : self.to_a[g]], return_counts=True)
            ids_b, n_b = np.unique(self.b[start_b[g] : self.to_b[g]], return_counts=True)
            more_keys.append((((owner[g] * IDS + ids_a) * IDS)[:, None] + ids_b).ravel())
            more_times.append((n_a[:, None] * n_b).ravel())
        if len(more_keys) > 1:
            keys, times = np.concatenate(more_keys), np.concatenate(more_times)
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            keys, times = keys[first], np.add.reduceat(times, first)
        return keys // (IDS * IDS), keys // IDS % IDS, keys % IDS, times


def align(docs: DataFrame, byte_model: str, vocabulary: Vocabulary) -> DataFrame:
    """Tokens and groups of every text: (doc_id, a_ids, b_ids, a_ends, b_ends).

    ``a_ids`` are the ids of a blank and the text by the byte-level tokenizer of ``byte_model``
    (a tokenizer file's text), ``b_ids`` those of the text by the piece model, which adds the
    blank. Group k holds the tokens behind ``a_ends[k - 1]`` up to ``a_ends[k]``, likewise of b.
    Texts that are null or empty, or whose bytes either side does not give back, have no tokens.
    Bytes that are no UTF-8 are read as U+FFFD. Rows that repeat are aligned again, a null id
    stays null, other columns are not read. Work and memory grow with one text's length.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(Models(byte_model, vocabulary))

    def run(batches):
        units = sent.value.units
        for batch in batches:
            ids, raw = batch.column(0), text_bytes(batch.column(1))
            for start, end in chunks(raw, SIDE_BY_SIDE):
                chunk = Chunk(units, [(t or b"").decode("utf-8", "replace") for t in raw[start:end]])
                texts = [(chunk.a, chunk.of_a), (chunk.b, chunk.of_b)]
                texts += [(to - np.repeat(of[:-1], np.diff(chunk.of_group)), chunk.of_group)
                          for to, of in ((chunk.to_a, chunk.of_a), (chunk.to_b, chunk.of_b))]
                lists = [pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(v, pa.int32())) for v, of in texts]
                yield pa.RecordBatch.from_arrays([ids.slice(start, end - start), *lists], ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


ROW = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "at array<int>, times array<int>, start int, pairs array<long>, docs array<int>"
)


def blocks(docs: DataFrame, byte_model: str, vocabulary: Vocabulary) -> DataFrame:
    """Documents in blocks of bounded size, and what each block's documents link.

    A row per document has its counts and its distinct linked pairs: where each stands in its
    block's list (``at``) and how often it is linked (``times``). Rows with ``pairs`` have parts
    of that list, from ``start`` on, and in how many of the block's documents each pair stands.
    A pair is one number, id of a times ``IDS`` plus id of b.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(Models(byte_model, vocabulary))
    names = [part.split()[0] for part in ROW.split(", ")]

    def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

    def batch_of(size: int, **columns) -> pa.RecordBatch:
        kinds = {"groups_sha256": pa.string(), "at": pa.list_(pa.int32()), "times": pa.list_(pa.int32()), "start": pa.int32(),
                 "pairs": pa.list_(pa.int64()), "docs": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays([columns.get(n, pa.nulls(size, kinds.get(n, pa.int64()))) for n in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = sent.value.units
        text, used = digits(max(len(units.size_a), len(units.size_b)))
        block = TaskContext.get().partitionId() << 32
        place_of: dict[int, int] = {}
        docs_of = np.zeros(0, np.int64)
        held = 0

        def finished() -> Iterator[pa.RecordBatch]:
            pairs = np.fromiter(place_of, np.int64, len(place_of))
            for start in range(0, len(pairs), ROW_PAIRS):
                part = slice(start, min(start + ROW_PAIRS, len(pairs)))
                end = [0, part.stop - start]
                yield batch_of(1, block=pa.array([block]), start=pa.array([start], pa.int32()),
                               pairs=lists(pairs[part], end, pa.int64()), docs=lists(docs_of[part], end, pa.int32()))

        for batch in batches:
            ids, raw = batch.column(0), text_bytes(batch.column(1))
            for start, end in chunks(raw, SIDE_BY_SIDE):
                chunk = Chunk(units, [(t or b"").decode("utf-8", "replace") for t in raw[start:end]])
                owner, a, b, times = chunk.pairs()
                pairs, at, here = np.unique(a * IDS + b, return_inverse=True, return_counts=True)
                # New pairs get the next places of the block's list.
                places = np.fromiter((place_of.setdefault(p, len(place_of)) for p in pairs.tolist()), np.int64, len(pairs))
                docs_of = np.concatenate((docs_of, np.zeros(len(place_of) - len(docs_of), np.int64)))
                docs_of[places] += here
                size = end - start
                ends = np.searchsorted(owner, np.arange(size + 1))
                found = [hashlib.sha256(t).hexdigest() if t else "" for t in chunk.written(text, used)]
                yield batch_of(
                    size,
                    block=pa.array(np.full(size, block)),
                    doc_id=ids.slice(start, size),
                    n_a=pa.array(np.diff(chunk.of_a)),
                    n_b=pa.array(np.diff(chunk.of_b)),
                    n_groups=pa.array(np.diff(chunk.of_group)),
                    n_links=pa.array(chunk.per_text(chunk.links)),
                    groups_sha256=pa.array(found, pa.string()),
                    at=lists(places[at], ends, pa.int32()),
                    times=lists(times, ends, pa.int32()),
                )
                held += sum(len(t or b"") for t in raw[start:end])
                if held >= BLOCK_BYTES or len(place_of) >= BLOCK_PAIRS:
                    yield from finished()
                    place_of.clear()
                    docs_of, held, block = docs_of[:0], 0, block + 1
        yield from finished()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, ROW)


def best_links(docs: DataFrame, byte_model: str, vocabulary: Vocabulary) -> DataFrame:
    """Counts of every document's tokens, groups and links, and how its links rank in all documents.

    Returns (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). Tokens and
    groups are those of ``align``; a link is a token of a and one of b in the same group. The
    count of an id pair is the number of documents (rows) that hold it linked; ``count_sum`` adds
    the counts of a document's links, ``n_best`` are its links whose count is the highest of
    their id of a, ties included. Without tokens all are zero and the digest is empty.

    Documents are aligned once, in blocks of bounded size; only the distinct pairs of a block
    are shuffled for counting, and what a block needs to know comes back to it alone. A pair
    that is in all blocks has a row per block, so its partition can be split.
    """
    rows = stored(blocks(docs, byte_model, vocabulary), "aligned")
    some = rows.where("pairs IS NOT NULL")
    place = F.arrays_zip(F.sequence(F.col("start"), F.col("start") + F.size("pairs") - 1).alias("at"), "pairs", "docs")
    listed = some.select("block", F.explode(place).alias("p")).select("block", "p.at", F.col("p.pairs").alias("pair"), "p.docs")
    counts = stored(listed.groupBy("pair").agg(F.sum("docs").alias("n")), "pair-counts")
    counts = counts.withColumn("a", F.shiftright("pair", 20))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    ranked = counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    asked = split_join(listed.select("block", "at", "pair"), ranked, "pair")
    asked = asked.select(F.col("block").alias("asker"), "at", "n", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy()
        out = []
        for batch in left.to_batches():
            lists = batch.column(batch.schema.get_field_index("at"))
            ends = lists.offsets.to_numpy()
            places = lists.values.to_numpy()
            times = batch.column(batch.schema.get_field_index("times")).values.to_numpy()
            sums = [np.concatenate(([0], np.cumsum(times * v[places]))) for v in (best, n)]
            n_best, count_sum = (pa.array((s[ends[1:]] - s[ends[:-1]]).astype(np.int64)) for s in sums)
            same = [batch.column(batch.schema.get_field_index(c)) for c in [*names, "groups_sha256"]]
            out.append(pa.RecordBatch.from_arrays([*same[:-1], n_best, count_sum, same[-1]], [*names, "n_best", "count_sum", "groups_sha256"]))
        schema = pa.schema([(c, pa.int64()) for c in [*names, "n_best", "count_sum"]] + [("groups_sha256", pa.string())])
        return pa.Table.from_batches([b.cast(schema) for b in out], schema)

    own = rows.where("pairs IS NULL").select("block", *names, "groups_sha256", "at", "times")
    schema = ", ".join(f"{c} long" for c in [*names, "n_best", "count_sum"]) + ", groups_sha256 string"
    return own.groupBy("block").cogroup(asked.groupBy("asker")).applyInArrow(finish, schema)


def byte_model_text(raw: bytes) -> str:
    """A tokenizer file's text, if it is a byte-level one that adds no blank and normalises nothing."""
    text = raw.decode()
    model = json.loads(text)
    before = model.get("pre_tokenizer") or {}
    if model.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("not a plain byte-level tokenizer")
    return text
