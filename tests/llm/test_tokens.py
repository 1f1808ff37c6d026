"""Encoding, decoding and aligning tokens, against the tokenizers' own libraries."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rapport.llm import alignment, pieces, queries

SF = "/root/testdata/sf0.001"
MODEL = queries.read_bytes(queries.PIECE_MODEL)
LETTERS = [" ", "  ", "a", "e", "th", "the", "ing", "\n", "\t", "é", "日", "本", "▁", "\U0001f600", "　", "0", "12", "...", "--",
           "aaaa", "\x00", "ﬁ", "é", "​", "<s>", "<0x0A>", "The", " of", "�", "<|endoftext|>", "\x1c", " "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_model(MODEL)


def odd_texts():
    rng = random.Random(2)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    return texts + ["a" * 5000, "ab" * 5000, " " * 5000, "日本語" * 3000, "=-" * 3000, "word " * 60_000, "▁ " * 2000]


def odd_rows(spark):
    """Null, empty, long and broken texts, repeated rows, a null id, columns with clashing names."""
    texts = [None, "", " ", "a b", "a b", "one ▁ two", "the cat " * 40_000, "é" * 7, "<s> is </s>", "<|endoftext|>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a b"), (3, "another"), (None, "no id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    broken = spark.sql("SELECT 99L AS doc_id, cast(X'636166E920E38100' AS string) AS text")
    names = ["ids", "decoded", "block", "pair", "pairs", "n", "n_a", "a", "b", "place", "times", "raw", "x.y"]
    return df.union(broken).select("*", *[F.lit(f"{n}!").alias(n) for n in names])


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- op12 --------------------------------------------------------------------------------------


def test_ids_equal_the_library(vocabulary, library):
    own = pieces.Encoder(vocabulary)
    texts = odd_texts()
    assert [own.encode(t) for t in texts] == library.encode(texts)


def test_full_caches_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 20)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 50)
    monkeypatch.setattr(pieces, "SLICE", 7)
    own = pieces.Encoder(vocabulary)
    texts = odd_texts()[:1500]
    assert [own.encode(t) for t in texts] == library.encode(texts)
    assert len(own.words) <= 10 and len(own.words.older) <= 10 and own.asked <= 50


def test_decoded_ids_equal_the_library(vocabulary, library):
    own, rng = pieces.Encoder(vocabulary), random.Random(3)
    some = [0, 1, 2, 3, 13, 259, 28705]
    runs = [[rng.choice([*some, rng.randrange(3, 259), rng.randrange(32000), rng.randrange(195, 259)]) for _ in range(rng.randint(0, 6))]
            for _ in range(20_000)]
    assert [own.decode(r) for r in runs] == [library.decode(r) for r in runs]


def test_neighbours_hold_only_if_they_merge_to_themselves(vocabulary):
    own, rng = pieces.Encoder(vocabulary), random.Random(4)
    normal = [i for i, w in enumerate(vocabulary.whole) if w]
    for _ in range(3000):
        a, b = rng.choice(normal), rng.choice(normal)
        text = vocabulary.pieces[a] + vocabulary.pieces[b]
        assert own.holds(a, b) == (pieces.merged(text, own.score) == [vocabulary.pieces[a], vocabulary.pieces[b]])
        assert own.cut(text) == [vocabulary.pieces.index(p) for p in pieces.merged(text, own.score)]


def test_models_of_another_kind_are_refused():
    # The same model without its identity normaliser: blanks in front are not kept.
    changed = MODEL.replace(b"\x1a\x12\n\x08identity\x12\x00\x18\x01 \x00", b"\x1a\x12\n\x08identity\x12\x00\x18\x00 \x00")
    assert changed != MODEL
    with pytest.raises(ValueError, match="differs"):
        pieces.read_model(changed)


def test_encoding_odd_rows(spark, vocabulary, library):
    rows = odd_rows(spark)
    found = [tuple(r) for r in pieces.encode(rows, vocabulary).collect()]
    texts = [(r.doc_id, bytes(r.raw or b"").decode("utf-8", "replace")) for r in rows.select("doc_id", F.col("text").cast("binary").alias("raw")).collect()]
    want = [(i, library.encode(t), library.decode(library.encode(t))) for i, t in texts]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert pieces.encode(rows.limit(0), vocabulary).collect() == []


def test_op12_query(spark, library):
    found = {r.doc_id: tuple(r)[1:] for r in queries.op12_sentencepiece(spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text)
        assert found[i] == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
    assert public_tokenizers.path("piece_bpe_32k.model") == queries.PIECE_MODEL


# --- op11 --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_model():
    return alignment.byte_model_text(queries.read_bytes(queries.BYTE_MODEL))


@pytest.fixture(scope="module")
def both(byte_model, library):
    """Tokens of a text by both libraries, as (ids, bytes) a side; no tokens if the bytes differ."""
    tokenizer = Tokenizer.from_str(byte_model)
    tokenizer.encode_special_tokens = True
    letters = alignment.byte_letters()

    def tokens(text):
        a = tokenizer.encode(" " + text, add_special_tokens=False)
        raw_a = [bytes(letters[c] for c in t) for t in a.tokens]
        b = library.encode(text)
        names = [library.id_to_piece(i) for i in b]
        raw_b = [bytes([int(n[3:5], 16)]) if library.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]
        want = (" " + text).encode()
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            return ([], []), ([], [])
        return (a.ids, raw_a), (b, raw_b)

    return tokens


def plain_groups(a, b):
    """Groups as pairs of lists of ids: tokens are taken from both sides until both end at one place."""
    (ids_a, raw_a), (ids_b, raw_b) = a, b
    ends_a, ends_b = (list(itertools.accumulate(map(len, raw))) for raw in (raw_a, raw_b))
    common, out, i, j = set(ends_a) & set(ends_b), [], 0, 0
    for end in sorted(common):
        k, n = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        out.append([ids_a[i:k], ids_b[j:n]])
        i, j = k, n
    return out


def plain_rows(texts, both):
    """The result of ``best_links`` by its definition."""
    found = [plain_groups(*both(t or "")) for t in texts]
    links = [[(i, j) for a, b in groups for i in a for j in b] for groups in found]
    count = Counter(pair for every in links for pair in set(every))
    top = {}
    for (i, _), n in count.items():
        top[i] = max(n, top.get(i, 0))
    rows = []
    for groups, every in zip(found, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(every),
                     sum(count[p] == top[p[0]] for p in every), sum(count[p] for p in every), digest(written) if written else ""))
    return rows


def test_units_equal_the_libraries(byte_model, vocabulary, both):
    units = alignment.Units(byte_model, vocabulary)
    for text in odd_texts():
        a, b = (np.frombuffer(x, np.int32).tolist() for x in units.of(text))
        assert [a, b] == [ids for ids, _ in both(text)], text[:80]


def test_groups_end_at_all_common_ends():
    rng = np.random.default_rng(6)
    for _ in range(400):
        ends, spans, total = ([], []), [], 0
        for _ in range(rng.integers(0, 5)):
            size = int(rng.integers(1, 60))
            for side in ends:
                inner = rng.choice(np.arange(1, size), rng.integers(0, size), replace=False) if size > 1 else []
                side.append(total + np.sort([*inner, size]))
            total += size
        of = [np.cumsum([0, *map(len, side)]) for side in ends]
        spans = np.stack((of[0][:-1], of[0][1:], of[1][:-1], of[1][1:]), axis=1).astype(np.int64)
        a, b = (np.concatenate(side).astype(np.int64) if side else np.empty(0, np.int64) for side in ends)
        to_a, to_b = alignment.groups(a, b, spans)
        common = np.intersect1d(a, b)
        assert a[to_a - 1].tolist() == common.tolist() == b[to_b - 1].tolist()


def test_long_groups_without_a_common_end():
    a = np.arange(2, 200_001, 2)
    b = np.append(np.arange(1, 200_000, 2), 200_000)
    to_a, to_b = alignment.groups(a, b, np.array([[0, len(a), 0, len(b)]]))
    assert to_a.tolist() == [len(a)] and to_b.tolist() == [len(b)]


@pytest.mark.parametrize("wide", [4096, 3])
def test_best_links_equal_brute_force(spark, byte_model, vocabulary, both, monkeypatch, wide):
    monkeypatch.setattr(alignment, "WIDE", wide)
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 300)
    monkeypatch.setattr(alignment, "ROW_PAIRS", 50)
    monkeypatch.setattr(alignment, "SIDE_BY_SIDE", 2000)
    texts = odd_texts()[:600] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = sorted(tuple(r) for r in alignment.best_links(df, byte_model, vocabulary).collect())
    assert found == [(i, *row) for i, row in enumerate(plain_rows(texts, both))]


def test_aligned_groups_are_spans_of_equal_bytes(spark, byte_model, vocabulary, both):
    texts = odd_texts()[:200] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in alignment.align(df, byte_model, vocabulary).collect():
        groups = plain_groups(*both(texts[r.doc_id] or ""))
        ends = zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends)
        assert [[r.a_ids[i:j], r.b_ids[k:n]] for i, j, k, n in ends] == groups


def test_aligning_odd_rows(spark, byte_model, vocabulary, both):
    rows = odd_rows(spark)
    texts = [(r.doc_id, bytes(r.raw or b"").decode("utf-8", "replace")) for r in rows.select("doc_id", F.col("text").cast("binary").alias("raw")).collect()]
    want = [(i, *row) for (i, _), row in zip(texts, plain_rows([t for _, t in texts], both))]
    found = [tuple(r) for r in alignment.best_links(rows, byte_model, vocabulary).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert alignment.best_links(rows.limit(0), byte_model, vocabulary).collect() == []


def test_op11_query(spark, both):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    found = sorted(tuple(r) for r in queries.op11_alignment(spark, SF).collect())
    assert found == [(r.doc_id, *row) for r, row in zip(docs, plain_rows([r.text for r in docs], both))]
