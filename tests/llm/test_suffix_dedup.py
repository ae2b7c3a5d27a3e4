"""Operator 12 against a slow scan of every string, with odd rows, frequent strings and small pieces."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from fareflow.llm import suffix_dedup
from fareflow.llm.suffix_dedup import _resolve, multikey_order, runs, without_repeats

DOCS = "doc_id long, text string, id long, none string, at int"


def slow(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row."""
    def place(row):
        text = row[1] if row[1] is None else row[1].encode()
        th = 42 if text is None else xxhash.xxh64_intdigest(text, 42)
        return row[0] is None, row[0] or 0, th - (1 << 64) * (th >> 63)

    seen, out = set(), []
    for row in sorted(rows, key=place):
        text = (row[1] or "").encode()
        gone = np.zeros(len(text) + 2, bool)
        for at in range(len(text) - length + 1):
            string = text[at:at + length]
            if string in seen:
                gone[at + 1:at + 1 + length] = True
            seen.add(string)
        kept = bytes(b for b, g in zip(text, gone[1:-1], strict=True) if not g)
        out.append((row[0], len(text), len(text) - len(kept), int((gone[1:] & ~gone[:-1]).sum()), kept))
    return out


def check(spark, rows, length, partitions=3, **sizes):
    docs = spark.createDataFrame(rows, DOCS).repartition(partitions) if rows else spark.createDataFrame([], DOCS)
    got = without_repeats(docs, length=length, **sizes).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == Counter(slow(rows, length))


def passages(n, seed):
    """Texts with shared passages between own ones, near copies, exact copies and periodic text."""
    pick = random.Random(seed)
    word = ["ab", "é", "漢", "x", "the", "\n", "\x00", "  "]
    shared = ["".join(pick.choice(word) for _ in range(pick.randint(5, 40))) for _ in range(4)]
    texts = []
    for _ in range(n):
        text = "".join(pick.choice(shared) if pick.random() < 0.3 else pick.choice(word) for _ in range(pick.randint(0, 30)))
        if texts and pick.random() < 0.2:
            text = pick.choice(texts)
            cut = pick.randint(0, len(text))
            text = text[:cut] + pick.choice(["", "z"]) + text[cut:]
        texts.append(text)
    return [*texts, "a" * 300, "ab" * 200, "abc" * 90]


@pytest.mark.parametrize("seed, piece", [(1, 8192), (2, 5), (3, 1)])
def test_without_repeats(spark, monkeypatch, seed, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "KINDS", 2)
    texts = passages(60, seed)
    ids = random.Random(seed).sample(range(1000), len(texts))
    rows = [(i, t, 1, "x", 2) for i, t in zip(ids, texts, strict=True)]
    # null ids and texts, a repeated id, a repeated row, a row repeated under a null id
    rows += [(None, texts[0], 1, "x", 2), (None, texts[0], 1, "x", 2), (None, None, 1, "x", 2), (5000, None, 1, "x", 2), (5000, "", 1, "x", 2),
             (6000, "own text " * 9, 1, "x", 2), (6000, "other text " * 9, 1, "x", 2), rows[3], rows[3]]
    check(spark, rows, 20, gram=8, block_bytes=700, piece_bytes=64)
    check(spark, rows, 33, partitions=1, gram=11)


def test_hot_strings(spark, monkeypatch):
    """One passage in all texts, each between bytes of its own, so that its ends form large groups."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 16)
    passage = "the quick brown fox jumps over the lazy dog again and again until night falls"
    rows = [(n, f"{n * 7919:06d}{'' if n % 3 else 'q'}{passage[n % 2:]}{n * 104729:07d}", 1, "x", 2) for n in range(150)]
    check(spark, rows, 30, partitions=8, gram=9, block_bytes=200)


def test_empty(spark):
    check(spark, [], 20, gram=8)
    check(spark, [(1, None, 1, "x", 2), (2, "short", 1, "x", 2)], 20, gram=8)


def test_multikey_order():
    pick = random.Random(4)
    for _ in range(30):
        strings = [bytes(pick.choice([0, 0, 1, 255]) for _ in range(pick.randint(0, 21))) for _ in range(pick.randint(1, 60))]
        sizes = np.array([len(s) for s in strings])
        rows = np.frombuffer(b"".join(s.ljust(21, b"\0") for s in strings), np.uint8).reshape(-1, 21)
        order, common = multikey_order(rows, sizes)
        got = [strings[i] for i in order]
        assert got == sorted(strings)
        for before, own, n in zip(got, got[1:], common[1:], strict=False):
            assert before[:n] == own[:n] and (n == min(len(before), len(own)) or before[n] != own[n])


def test_runs_cover_every_start_and_depend_on_content_only():
    pick = random.Random(9)
    pieces = [bytes(pick.choice(b"abc") for _ in range(pick.randint(0, 200))) for _ in range(20)] + [b"a" * 150]
    piece, at, n, to, *_ = runs(pieces, 30, 8)
    starts = sorted((p, a + i) for p, a, m in zip(piece, at, n, strict=True) for i in range(m + 1))
    assert starts == [(p, i) for p, text in enumerate(pieces) for i in range(len(text) - 29)]
    place = {}
    for p, a, m, t in zip(piece, at, n, to, strict=True):
        for i in range(m + 1):  # equal strings choose the gram at the same place
            assert 0 <= t - i <= 22
            assert place.setdefault(pieces[p][a + i:a + i + 30], t - i) == t - i


def test_rows_of_a_hot_gram_grow_with_the_group():
    """Every run of a gram that many pieces share sends each of its strings at most once: rows in proportion, no pairs."""
    made = {}
    for n in (3000, 6000, 12000):
        pick = np.random.default_rng(7)
        before = [pick.integers(97, 123, 76, dtype=np.uint8).tobytes() for _ in range(n)]
        suffix = [b"g" * 24 + pick.integers(97, 123, 76, dtype=np.uint8).tobytes() for _ in range(n)]
        batch = pa.RecordBatch.from_arrays([pa.array(suffix, pa.binary()), pa.array(before, pa.binary()), pa.array([False] * n), pa.array(range(n)),
                                            pa.array([0] * n), pa.array([0] * n, pa.int32())], ["suffix", "before", "none", "id", "th", "at"])
        made[n] = sum(b.num_rows for b in _resolve(100, 24)([batch]))
        assert made[n] == 77 * n  # no two strings are equal: one row for each place of the gram
    assert made[12000] == 2 * made[6000] == 4 * made[3000]


def test_strings_of_a_gram_over_many_buckets_are_compared_where_they_are(spark, monkeypatch):
    """One passage with another word changed in each text: a bucket sends on the strings at its edges, not all of the gram."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    pick = random.Random(3)
    passage = bytes(pick.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(600)).decode()
    rows = []
    for n in range(600):
        at = pick.randrange(570)
        rows.append((n, f"{passage[:at]}{n * 7919:06d}{passage[at + 6:]}", 1, "x", 2))
    sent = spark.sparkContext.accumulator(0)
    resolve = suffix_dedup._resolve

    def counted(length, gram):
        run = resolve(length, gram)

        def each(batches):
            for batch in run(batches):
                sent.add(batch.num_rows - batch.column("window").null_count)
                yield batch
        return each

    monkeypatch.setattr(suffix_dedup, "_resolve", counted)
    check(spark, rows, 100, partitions=8, block_bytes=2000)
    assert sent.value < 6000  # 2,112; 23,017 when all strings of the gram at an edge went on
