"""Operator 11 against a slow alignment by the libraries, in one go and in byte ranges; the monoid's laws."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from fareflow.llm import token_alignment
from fareflow.llm.token_alignment import LEFT, RIGHT, Fragment, Tokens, align, cuts, sides

DOCS = "doc_id long, text string, row long, no string, pair int"
PARTS = [" ", "  ", "\n", "a", "B", "'s", "'LL", "é", "ß", "İ", "Σ", "́", "\x1c", "\xa0", "\x85", "1", "½", "_", "!!", "<|endoftext|>", "<s>",
         "漢", "😀", "the", "tion", "'", "▁", "\x00", "\t", " the", " a", " 12", " in the", "\nof"]


def texts(n, seed, most=40):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, most))) for _ in range(n)]


def tokens(text):
    """Ids and ends by the libraries, or None where the bytes do not come back."""
    a, b = sides(LEFT, RIGHT)
    out = []
    for side, ids in ((a, a.library.encode(" " + (text or ""), add_special_tokens=False).ids), (b, b.library.encode(text or ""))):
        if not text or b"".join(side.bytes[i] for i in ids) != b" " + text.encode():
            return None
        out.append((ids, np.cumsum([len(side.bytes[i]) for i in ids]).tolist()))
    return out


def slow(rows):
    found, counts = [], Counter()
    for row in rows:
        own, groups = tokens(row[1]), []
        if own:
            (a, a_end), (b, b_end) = own
            ends = sorted(set(a_end) & set(b_end))
            groups = [([i for i, e in zip(a, a_end, strict=True) if lo < e <= hi], [i for i, e in zip(b, b_end, strict=True) if lo < e <= hi])
                      for lo, hi in zip([0, *ends], ends, strict=False)]
        links = [(i, j) for x, y in groups for i in x for j in y]
        counts.update(set(links))
        found.append((row[0], groups, links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = Counter()
    for doc_id, groups, links in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out[(doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
             sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if groups else "")] += 1
    return out


@pytest.mark.parametrize("sizes", [{}, {"long_bytes": 30, "chunk": 9, "block_bytes": 200}, {"long_bytes": 0, "chunk": 2}])
def test_align(spark, monkeypatch, sizes):
    monkeypatch.setattr(token_alignment, "_MANY", 6)
    monkeypatch.setattr(token_alignment, "FAN", 3)
    own = [*texts(60, 2), *texts(6, 3, 300), "", None, None, "a", " ", "x ", " x", "ab " * 300, "long" * 100, "漢" * 50, "no\nspaces\nhere\n" * 20]
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(own)]
    rows += [rows[3], (None, own[5], 1, "x", 2), (3, "other", 1, "x", 2)]
    got = align(spark.createDataFrame(rows, DOCS).repartition(4), **sizes)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == slow(rows)


def test_empty(spark):
    for sizes in ({}, {"long_bytes": 0}):
        assert align(spark.createDataFrame([], DOCS), **sizes).count() == 0
        rows = [(1, None, 1, "x", 2), (2, "a▁b", 1, "x", 2)]
        assert Counter(map(tuple, align(spark.createDataFrame(rows, DOCS), **sizes).collect())) == slow(rows)


def test_left_ids_equal_the_library():
    left = sides(LEFT, RIGHT)[0]
    assert left.fast is not None
    own = texts(3000, 7)
    assert left.ids(own) == [left.library.encode(t, add_special_tokens=False).ids for t in own]


def test_ranges_do_not_change_tokens():
    for text in texts(1500, 8):
        if "▁" in text:
            continue
        raw = b" " + text.encode()
        for side, pattern, skip in zip(sides(LEFT, RIGHT), (token_alignment._LEFT_CUT, token_alignment._RIGHT_CUT), (0, 1), strict=True):
            for chunk in (3, 20):
                at = cuts(raw, pattern, chunk)
                ids = [i for x, y in zip(at, [*at[1:], len(raw)], strict=True) if y > x for i in side.ids([raw[x:y].decode()[skip:]])[0]]
                assert ids == side.ids([raw.decode()[skip:]])[0]


def test_fragments_are_a_monoid():
    """Any cut of the two token streams and any order of composition closes the same groups."""
    pick = random.Random(5)
    for _ in range(200):
        size = pick.randint(1, 40)
        ends = [np.array(sorted({*pick.sample(range(1, size + 1), pick.randint(1, size)), size})) for _ in range(2)]
        whole = Tokens(ends[0] * 10, ends[0], ends[1] * 10, ends[1])
        bounds = sorted(pick.randint(0, size) for _ in range(pick.randint(0, 5)))
        fragments, closed = [], []

        def keep(made, closed=closed):
            closed.append(made[1])
            return made[0]

        for low, high in zip([0, *bounds], [*bounds, size], strict=True):
            # the right side is cut somewhere else
            shift = lambda x: x if x in (0, size) else min(size, x + 2)
            i, j = np.searchsorted(whole.a_end, [low, high], "right")
            k, m = np.searchsorted(whole.b_end, [shift(low), shift(high)], "right")
            fragments.append(keep(Fragment.of(Tokens(whole.a[i:j], whole.a_end[i:j], whole.b[k:m], whole.b_end[k:m]))))
        while len(fragments) > 1:
            at = pick.randrange(len(fragments) - 1)
            fragments[at:at + 2] = [keep(fragments[at] + fragments[at + 1])]
        closed.append(fragments[0].prefix)
        assert fragments[0].closed and not len(fragments[0].suffix.a) and not len(fragments[0].suffix.b)
        got = sorted(e for t in closed for e in t.common().tolist())
        assert got == whole.common().tolist()
        assert sorted(e for t in closed for e in t.a_end.tolist()) == whole.a_end.tolist()
        assert sorted(e for t in closed for e in t.b_end.tolist()) == whole.b_end.tolist()
