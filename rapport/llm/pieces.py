"""Encoding texts to the ids of a merge-type piece model, and back, without its library.

Encoding goes from left to right and takes back what does not hold: the longest piece that
starts here (Aho-Corasick) is tried first, then its shorter prefixes. A piece may follow
another if merging their letters again gives just these two. Where no piece may follow, the
place is marked as failed and the last piece is replaced by a shorter one. If every two
neighbours hold, merging the whole text gives these pieces too: the first merge across a
border would have to happen between two of them alone as well.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import small_batches, text_bytes

# A blank inside pieces.
SPACE = "▁"
# What an unknown id decodes to.
UNKNOWN = " ⁇ "
# Words kept with their ids at most: half of them since the last change, half from before it, of
# which those used go on. Pairs of pieces kept with the answer, at most; then these start anew.
KEPT_WORDS = 400_000
KEPT_PAIRS = 1_000_000
KEPT_LETTERS = 64
# Below any score: these do not merge.
NEVER = float("-inf")
# Letters of a text that are cut into words at a time.
SLICE = 1 << 18
# Texts that a model must encode and decode like its library before it is used.
PROBES = ["", " ", "a  b", "The cat's hat, 12.5%", "x\ty\r\n", "été 日本 \U0001f600", "▁ x", "<s> <0x0A> </s>", " " * 40]


@dataclass(frozen=True)
class Vocabulary:
    """A model as plain data, small enough to go to every task: some 32,000 pieces."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]  # not control, unknown, byte or unused
    whole: list[bool]  # normal, and its letters merge to it
    silent: list[int]  # control ids, which have no text
    unknown: int
    single: list[int]  # id of each byte


def read_model(model: bytes) -> Vocabulary:
    """Vocabulary of a sentencepiece file of type BPE with byte pieces and plain normalisation.

    Any other is refused: its library must agree on ``PROBES``.
    """
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(library.get_piece_size())
    special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i) for i in ids]
    pieces = [library.id_to_piece(i) for i in ids]
    scores = [library.get_score(i) for i in ids]
    by_piece = {p: s for p, s, no in zip(pieces, scores, special) if not no}
    found = Vocabulary(
        pieces,
        scores,
        [not s for s in special],
        [not s and merged(p, by_piece) == [p] for p, s in zip(pieces, special)],
        [i for i in ids if library.is_control(i)],
        library.unk_id(),
        [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
    )
    own = Encoder(found)
    for text in PROBES:
        if (ids := own.encode(text)) != library.encode(text) or own.decode(ids) != library.decode(ids):
            raise ValueError(f"the model does not merge plain text with byte pieces: it differs on {text!r}")
    return found


class Model:
    """A vocabulary as it goes to the tasks; a worker builds its encoder once and keeps it for later tasks."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    @cached_property
    def encoder(self) -> Encoder:
        codecs.register_error("byte_by_byte", _byte_by_byte)
        return Encoder(self.vocabulary)


def _byte_by_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def merged(text: str, score: dict[str, float]) -> list[str]:
    """Merge neighbours of the best score, the leftmost first, until none can be."""
    parts = list(text)
    found = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while found and (best := max(found)) > NEVER:
        at = found.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del found[at]
        if at < len(found):
            found[at] = score.get(parts[at] + parts[at + 1], NEVER)
        if at:
            found[at - 1] = score.get(parts[at - 1] + parts[at], NEVER)
    return parts


class Encoder:
    """Ids of texts by backtracking, and texts of ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        pieces = vocabulary.pieces
        normal = [i for i, yes in enumerate(vocabulary.normal) if yes]
        self.score = {pieces[i]: vocabulary.scores[i] for i in normal}
        self.size = [len(p) for p in pieces]
        # Only pieces that their own letters merge to can be in an encoding.
        whole = {pieces[i]: i for i in normal if vocabulary.whole[i]}
        self.letters = {p for p in whole if len(p) == 1}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for piece, i in whole.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        # Of each piece the longest one that it starts with, or -1.
        self.shorter = [-1] * len(pieces)
        for piece, i in whole.items():
            self.shorter[i] = next((whole[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in whole), -1)
        # No piece goes on over a blank, so words can be encoded one by one.
        self.by_word = not any(SPACE in pieces[i].lstrip(SPACE) for i in normal)
        self.raw = [p.replace(SPACE, " ").encode() if n else b"" for p, n in zip(pieces, vocabulary.normal)]
        for byte, i in enumerate(vocabulary.single):
            self.raw[i] = bytes([byte])
        self.raw[vocabulary.unknown] = UNKNOWN.encode()
        self.silent = set(vocabulary.silent)
        self.words = Kept()
        # Of each piece, and of none, what fits behind it of those asked for.
        self.follow: list[dict[int, int]] = [{} for _ in range(len(pieces) + 1)]
        self.asked = 0

    # --- encoding

    def holds(self, last: int, piece: int) -> bool:
        """May ``piece`` follow ``last``: do their letters merge to these two."""
        a, b = self.vocabulary.pieces[last], self.vocabulary.pieces[piece]
        return merged(a + b, self.score) == [a, b]

    def fitting(self, last: int, piece: int) -> int:
        """The longest of ``piece`` and the pieces it starts with that may follow ``last``, or -1. Any may be the first."""
        self.asked += 1
        if self.asked > KEPT_PAIRS:
            self.asked = 1
            for known in self.follow:
                known.clear()
        found, known = piece, self.follow[last]
        while last >= 0 and found >= 0 and not self.holds(last, found):
            found = known.get(self.shorter[found], self.shorter[found])
        known[piece] = found
        return found

    def cut(self, text: str) -> list[int]:
        """Ids of a text whose letters are all known."""
        size, shorter, follow, stop = self.size, self.shorter, self.follow, len(text)
        longest = [0] * stop if stop < SLICE else array("i", bytes(4 * stop))
        for end, piece in self.automaton.iter(text):
            longest[end - size[piece] + 1] = piece
        failed = bytearray(stop // 8 + 1)
        marked = False
        taken: list[int] = []
        at, piece, last = 0, longest[0], -1
        while True:
            if piece >= 0:
                known = follow[last]
                fit = known.get(piece)
                if fit is None:
                    fit = self.fitting(last, piece)
                # A shorter one, if nothing may stand behind this one.
                while marked and fit >= 0 and failed[(at + size[fit]) >> 3] >> (at + size[fit] & 7) & 1:
                    piece = shorter[fit]
                    fit = known.get(piece, -2) if piece >= 0 else -1
                    if fit == -2:
                        fit = self.fitting(last, piece)
                piece = fit
            if piece >= 0:
                taken.append(piece)
                at += size[piece]
                if at == stop:
                    return taken
                last, piece = piece, longest[at]
            else:
                # No piece may stand here: the one before was too long.
                failed[at >> 3] |= 1 << (at & 7)
                marked = True
                last = taken.pop()
                at -= size[last]
                piece = shorter[last]
                last = taken[-1] if taken else -1

    def unit(self, text: str) -> array:
        """Ids of a text in which blanks are written as in pieces, without the one in front."""
        ids = array("i")
        start, letters = 0, self.letters
        if not letters.issuperset(text):
            # A letter without a piece merges with nothing: it parts the text and is written in bytes.
            for at, letter in enumerate(text):
                if letter not in letters:
                    if start < at:
                        ids.extend(self.cut(text[start:at]))
                    ids.extend(map(self.vocabulary.single.__getitem__, letter.encode()))
                    start = at + 1
        if start < len(text):
            ids.extend(self.cut(text[start:]))
        return ids

    def parts(self, text: str) -> Iterator[bytes]:
        """Ids of a text as 32-bit numbers, word by word."""
        if not text:
            return
        if not self.by_word:
            yield self.unit(SPACE + text.replace(" ", SPACE)).tobytes()
            return
        known = self.words
        front: list[str] = []
        for word in words(text):
            if not word or word[-1] == SPACE:
                # The next blank goes on with this one.
                front.append(word)
                continue
            if front:
                front.append(word)
                word, front = SPACE.join(front), []
            ids = known.get(word) or known.find(word)
            if ids is None:
                ids = self.unit(SPACE + word).tobytes()
                if len(word) <= KEPT_LETTERS:
                    known.keep(word, ids)
            yield ids
        if front:
            yield self.unit(SPACE + SPACE.join(front)).tobytes()

    def encode(self, text: str) -> list[int]:
        return array("i", b"".join(self.parts(text))).tolist()

    # --- decoding

    def decode(self, ids: list[int]) -> str:
        """Text of ids: one blank in front goes, bytes that form no letter are marked one by one.

        Ids without a text end a run of bytes, so that no letter goes across them.
        """
        first = next((i for i in ids if i not in self.silent), None)
        if first is None:
            return ""
        if self.silent.isdisjoint(ids):
            runs = [ids]
        else:
            runs = [list(run) for silent, run in groupby(ids, self.silent.__contains__) if not silent]
        text = "".join(b"".join(map(self.raw.__getitem__, run)).decode("utf-8", "byte_by_byte") for run in runs)
        return text[1:] if self.vocabulary.normal[first] and text[:1] == " " else text


class Kept(dict):
    """Words with their ids; those not used for long are forgotten."""

    older: dict = {}

    def find(self, word: str):
        """Ids of a word that is not among the newer ones; it becomes one of them."""
        found = self.older.get(word)
        if found is not None:
            self.keep(word, found)
        return found

    def keep(self, word: str, ids) -> None:
        if len(self) >= KEPT_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids


def words(text: str) -> Iterator[str]:
    """What stands between the blanks of a text, some thousand words at a time."""
    start = 0
    while start <= len(text):
        end = text.find(" ", start + SLICE)
        end = len(text) if end < 0 else end
        yield from text[start:end].split(" ")
        start = end + 1


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Ids of every text, and the text they decode to: (doc_id, ids, decoded).

    No begin or end ids, no sampling. Texts that are null or empty have no ids and decode to an
    empty text. Bytes that are no UTF-8 are read as U+FFFD. Texts of any length are encoded as a
    whole; rows that repeat are encoded again; a null id stays null; other columns are not read.
    Each row is encoded by itself, nothing is shuffled. A worker keeps ``KEPT_WORDS`` words and
    ``KEPT_PAIRS`` pairs of pieces at most with their results, also for its next tasks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(Model(vocabulary))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def run(batches):
        encoder = sent.value.encoder
        for batch in batches:
            ids, ends, decoded = [], array("i", [0]), []
            for raw in text_bytes(batch.column(1)):
                found = b"".join(encoder.parts((raw or b"").decode("utf-8", "replace")))
                ids.append(found)
                ends.append(ends[-1] + len(found) // 4)
                decoded.append(encoder.decode(array("i", found)))
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


codecs.register_error("byte_by_byte", _byte_by_byte)
