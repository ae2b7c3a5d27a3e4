"""Each operator against brute force on small tables, with nulls, ties, repeats and odd columns."""

import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fareflow.llm import golay, language_id, quality, simhash_dedup
from fareflow.llm.common import tokenizer_file
from fareflow.llm.decontaminate import ContainmentIndex, contained_items, drop_contaminated, shingles
from fareflow.llm.licenses import license_matches, scan
from fareflow.llm.line_dedup import drop_boilerplate
from fareflow.llm.packing import FIRST, K1, B, Shard, Slots, layout, pack_documents
from fareflow.llm.simhash_dedup import drop_near_duplicates, fingerprint, fuzzy_keys, near_duplicates, spanning_links
from fareflow.llm.token_counts import token_counts
from fareflow.llm.token_files import decode, encode, read_token_files, write_token_files
from fareflow.llm.tokens import TextIds, UnitTable, pre_tokens, text_ids
from fareflow.llm.topk_search import top_k
from fareflow.operators.incremental import shared_table_path

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key int, ids string, block string, score string"
ODD = ["", "   \n\t", "a", "Don't 's 'll", "É é ß Å Å İ Σς", "x<|endoftext|>y", "漢字 и 😀 1 23 ½", "\x00\x1c\x85\xa0　z",
       "line one\nline two\n\nline one", "ab " * 30_000, "long" * 20_000]


def rows_of(texts, ids=None):
    ids = list(range(1, len(texts) + 1)) if ids is None else ids
    return [(i, t, "en" if (n % 2) else None, f"host{n % 2}" if n % 5 else None, 0 if t is None else len(t), n, "x", "y", "z")
            for n, (i, t) in enumerate(zip(ids, texts, strict=True))]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null text, null and repeated doc_ids, an exactly repeated row."""
    texts = [*ODD, None, "same text", "same text", "null id"]
    rows = rows_of(texts, [*range(1, len(ODD) + 1), 90, 91, 91, None])
    return spark.createDataFrame([*rows, rows[4]], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def library(name):
    t = Tokenizer.from_file(tokenizer_file(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=3):
    pick = random.Random(seed)
    parts = [" ", "  ", "\n", "a", "B", "'s", "'LL", "é", "ß", "İ", "Σ", "́", "\x1c", "\xa0", " ", "1", "½", "_", "!!", "<|endoftext|>",
             "<|", "漢", "😀", "the", "tion", "'", "Å", "Å", "T̈"]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 12))) for _ in range(n)]


def test_ids_equal_the_library():
    texts = random_texts(4000) + ODD
    word, byte = library(WORD), library(BYTE)
    assert [x.tolist() for x in text_ids(WORD).all_ids(texts)] == [word(t) for t in texts]
    assert [np.frombuffer(text_ids(WORD).ids(t), "<u4").tolist() for t in texts[:1000]] == [word(t) for t in texts[:1000]]
    cut = pre_tokens(BYTE)
    assert [sum(map(cut.count, cut.cut(t))) for t in texts] == [len(byte(t)) for t in texts]


def test_token_counts(spark, odd, empty):
    byte = library(BYTE)
    wanted = sorted((str(r.doc_id), len((r.text or "").encode()), len(byte(r.text))) for r in odd.collect())
    for block in (1, 1 << 24):  # a block for each text, and one for all
        got = token_counts(odd, block_bytes=block).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == wanted
    assert token_counts(empty).count() == 0


def test_segment_codec():
    for seed in range(60):
        pick = np.random.default_rng(seed)
        ids = pick.integers(0, 2 ** int(pick.choice([0, 1, 5, 16, 31, 32])), int(pick.integers(0, 1500)), dtype=np.uint64).astype(np.uint32)
        data = encode(ids)
        assert (decode(data) == ids).all()
        if len(ids):
            assert (decode(data, 1, 3) == ids[256:768]).all()


def test_token_files_round_trip(spark, odd, empty):
    word = library(WORD)
    path = shared_table_path(spark, "test-token-files")
    write_token_files(odd, path, segment_ids=1000)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    keys = [(-1 if r.doc_id is None else r.doc_id) for r in got]
    assert keys == sorted(keys)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    wanted = sorted((str(r.doc_id), word(r.text) + [1]) for r in odd.collect())
    assert sorted((str(r.doc_id), np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in got) == wanted
    path = shared_table_path(spark, "test-token-files")
    write_token_files(empty, path)
    assert read_token_files(spark, path).count() == 0


def test_layout_fills_windows():
    for seed in range(30):
        lengths = np.random.default_rng(seed).integers(1, 50, 20)
        place, start, length, sequence, offset = layout(lengths, 16)
        assert length.sum() == lengths.sum()
        assert all((np.bincount(sequence, length) == 2 ** np.log2(np.bincount(sequence, length)).astype(int)))
        for d in range(len(lengths)):
            assert start[place == d].tolist() == np.cumsum([0, *length[place == d][:-1]]).tolist()


def test_packing_covers_every_id_once(spark, odd, empty):
    word = library(WORD)
    for shard in (4, 1024):
        got = pack_documents(odd, window=64, shard_docs=shard).collect()
        sequences = {}
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert sequences.get(r.sequence_id, 0) == r.offset
            sequences[r.sequence_id] = r.offset + r.length
        assert all(n & (n - 1) == 0 and n <= 64 for n in sequences.values())
        # rows with the same doc_id are told apart by nothing but their texts: compare the ids as a multiset
        assert sorted(i for r in got for i in np.frombuffer(bytes(r.ids), "<u4")) == sorted(i for r in odd.collect() for i in [*word(r.text), 1])
        one = {r.doc_id: [*word(r.text), 1] for r in odd.where("doc_id < 90").collect()}
        for r in got:
            if r.doc_id in one and r.doc_id != 5:
                assert np.frombuffer(bytes(r.ids), "<u4").tolist() == one[r.doc_id][r.start:r.start + r.length]
    assert pack_documents(empty).count() == 0


def test_unit_table_keeps_short_units_in_fixed_memory():
    words = [a + b + c for a in "bdfg" for b in "aeiou" for c in "klmnprst"]
    texts = random_texts(500) + ODD + [" ".join(words), " ".join(reversed(words)), "x" * 40 + " 1234 " + "é" * 12]
    encoder, word = TextIds(WORD), library(WORD)
    for bits in (1, 4, 12):  # few slots: units drive one another out
        encoder.table = UnitTable(bits)
        for _ in range(2):
            assert [x.tolist() for x in encoder.all_ids(texts, most_bytes=100)] == [word(t) for t in texts]
    assert not encoder.units.keys() & {w.encode() for w in words}


def test_neighbours_are_sorted_by_score_in_parts():
    pick = np.random.default_rng(5)
    terms = [np.unique(pick.integers(0, 60, pick.integers(0, 30))) for _ in range(4 * FIRST + 40)]
    counts = [pick.integers(1, 4, len(t)) for t in terms]
    idf, n = pick.random(60).astype(np.float32), len(terms)
    shard, mean = Shard(terms, counts, idf, 20.0), np.float32(20.0)
    assert 0 < len(shard.rows) and len(shard.term)  # terms of many documents and of few
    scores = np.zeros(n)
    for doc, (t, c) in enumerate(zip(terms, counts, strict=True)):
        tf = c.astype(np.float32)
        weight = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * np.float32(c.sum()) / mean))
        scores[doc] = weight[np.isin(t, terms[3])].sum(dtype=np.float64)
    for doc in (0, 3, 7):
        shard.use(doc)
    got = list(shard.neighbours(3))
    assert sorted(got) == [d for d in range(n) if d not in (0, 3, 7)]
    assert (np.diff(scores[got]) < 1e-5).all()


def test_packing_puts_lexical_neighbours_together(spark):
    texts = [f"{'apple pear plum' if n % 2 else 'steel iron copper'} word{n}" for n in range(8)]
    got = pack_documents(spark.createDataFrame(rows_of(texts), DOCS).coalesce(1), window=16).collect()
    order = [r.doc_id % 2 for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert order[:3] == [order[0]] * 3


def test_packing_shards_by_content(spark):
    """Documents of like content meet in a shard, however the scan deals them; a hot group of copies spreads."""
    pick = random.Random(8)
    words = [[f"{a}{b}{c}" for b in "bdfgk" for c in "lmnrs"] for a in ("ka", "po", "ti", "zu")]
    words = [[w + "".join(pick.choice("aeiou") for _ in range(4)) for w in group] for group in words]
    texts = [" ".join(pick.choice(words[n % 4]) for _ in range(30)) for n in range(640)]
    docs = spark.createDataFrame(rows_of(texts), DOCS).repartition(16)
    sequences = {}
    for r in pack_documents(docs, window=256, shard_docs=40).collect():
        sequences.setdefault(r.sequence_id, set()).add((r.doc_id - 1) % 4)
    assert sum(len(kinds) == 1 for kinds in sequences.values()) >= 0.8 * len(sequences)

    terms = [np.array(sorted(pick.sample(range(1000), 20))) for _ in range(500)]
    sample = [(t, np.ones(20, np.int64)) for t in [terms[0]] * 500 + terms]
    slots = Slots(sample, np.full(1 << 18, 3.0, np.float32), 10_000, 10)
    copies = slots.of(list(range(1000)), [terms[0]] * 1000, [np.ones(20, np.int64)] * 1000)
    assert np.unique(copies, return_counts=True)[1].max() < 20


def test_top_k(spark):
    pick = random.Random(1)
    nan = float("nan")
    rows = [(i, [pick.choice([-0.5, 0.0, 0.01, 0.3, 0.7]) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (220, [nan] * 6), (240, [0.1, None, 0.2, 0.0, 0.0, 0.0]), (None, [1.0] * 6), (260, []), (280, [0.5])]
    rows += [(300, [9.0] * 6)] * 3  # a query that repeats, three candidates of the same id
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, v string")
    use = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    wanted = set()
    for q, a in {(i, tuple(v)) for i, v in use if i % 20 == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q)[:20]
        wanted |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    got = top_k(df, F.col("vec_id") % 20 == 0, query_block=3, candidate_block=25)
    assert {tuple(r) for r in got.collect()} == wanted
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_large_components(spark):
    rows = [(0, [200_000.0, 1.0]), (1, [131_073.0, 0.0]), (2, [262_144.0, 0.0]), (3, [1e9, 0.0]), (4, [1e9, 0.5]), (5, [-1e12, 3.0])]
    df = spark.createDataFrame([*rows, (40, [1e9, 1e9])], "vec_id long, embedding array<double>")
    q = {i: [math.floor(64 * x) for x in v] for i, v in [*rows, (40, [1e9, 1e9])]}
    got = top_k(df, F.col("vec_id") == 0, k=5, scale=64).collect()
    wanted = sorted((-sum(x * y for x, y in zip(q[0], v)), i) for i, v in q.items() if i)[:5]
    assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == wanted
    with pytest.raises(Exception, match="64 bits"):
        top_k(spark.createDataFrame([(0, [1e300])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_containment(spark, odd, empty):
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdef") for _ in range(3))
    items = [" ".join(word() for _ in range(n)) for n in (5, 8, 13, 20, 33, 50, 3)]
    texts = []
    for item in items[:6]:
        words = item.split()
        for cut in (0, 1, len(words) // 8, len(words) // 3):  # from whole to too short
            texts.append(" ".join([word() for _ in range(300)] + [w.upper() + "," for w in words[cut:]] + [word() for _ in range(300)]))
    texts += [items[6], f"x {items[6]} y", None, ""]
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    benchmark = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (None, items[0])], "item_id long, text string")
    wanted = set()
    for d, t in enumerate(texts, 1):
        own = set(shingles(t or "", 5))
        for i, item in [*enumerate(items), (None, items[0])]:
            need = set(shingles(item, 5))
            if len(need & own) >= 0.8 * len(need):
                wanted.add((d, i, len(need & own), len(need), len(need & own) / len(need)))
    assert {tuple(r) for r in contained_items(docs, benchmark).collect()} == wanted and len(wanted) > 10
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(1, len(texts) + 1)) - {w[0] for w in wanted}
    assert contained_items(empty, benchmark).count() == 0 and contained_items(docs, benchmark.limit(0)).count() == 0
    assert drop_contaminated(odd, benchmark).count() == odd.count()


def test_containment_signature_misses_nothing():
    pick = random.Random(5)
    for size in range(1, 70):
        item = " ".join(f"w{pick.randrange(10**6)}" for _ in range(size + 4))
        index = ContainmentIndex([(1, item)], 5, 0.8)
        for _ in range(5):
            words = item.split()
            broken = words[:]
            broken[pick.randrange(len(words))] = "zz"
            own, need = set(shingles(" ".join(broken), 5)), set(shingles(item, 5))
            assert bool(index.search(" ".join(broken))) == (len(own & need) >= 0.8 * len(need))


def test_line_dedup(spark, odd, empty):
    texts = [f"header line\nown {n}\n\n header line \nfooter" if n % 3 else f"own {n}\nfooter" for n in range(30)] + [None, "", "footer"]
    docs = spark.createDataFrame([(n, t, "h" if n < 20 else None, 7, "x", "y") for n, t in enumerate(texts)],
                                 "doc_id long, text string, source string, n_chars int, host string, ratio string")
    got = {r.doc_id: r for r in drop_boilerplate(docs, ratio=0.5, min_pages=3, dropped="gone").collect()}
    assert len(got) == len(texts)
    for n, t in enumerate(texts):
        if t is None:
            assert got[n].text is None and got[n].gone == 0
            continue
        kept = "\n".join(line for line in t.split("\n") if line.strip() not in ("header line", "footer"))
        assert got[n].text == kept and got[n].n_chars == len(kept) and got[n].ratio == "y"
    assert drop_boilerplate(docs, ratio=0.99, min_pages=50).count() == len(texts)
    assert drop_boilerplate(empty).count() == 0 and drop_boilerplate(odd).count() == odd.count()


def test_line_dedup_keeps_groups_of_copies(spark):
    copy = "the copied page\nwith two lines"
    texts = [copy] * 20 + [f"menu\nown {n} text" for n in range(20)] + ["small copy"] * 4 + [None, None]
    hosts = ["hot"] * 40 + ["small"] * 6
    docs = spark.createDataFrame([(n, t, h) for n, (t, h) in enumerate(zip(texts, hosts, strict=True))], "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in drop_boilerplate(docs, copies=False).collect()}
    assert got == {n: t and t.removeprefix("menu\n") for n, t in enumerate(texts)}
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.line_dedup(spark, docs, ""), "")
    assert [r.text for r in kept.collect()].count(copy) == 1


def brute_components(texts, ids, distance=4):
    prints = [fingerprint(t or "") for t in texts]
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    first = {}
    for i, doc in enumerate(ids):
        first.setdefault(find(i), []).append(doc)
    least = {r: min((d for d in group if d is not None), default=None) for r, group in first.items()}
    return prints, [least[find(i)] for i in range(len(prints))], list(least.values())


def test_fingerprint():
    assert fingerprint("") == fingerprint(" \n\t") == 0
    assert fingerprint("One  two\nTHREE") == xxhash.xxh64_intdigest(b"one two three", 42)
    text = "a b c d e a b c d"
    words = text.split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(6)]
    assert fingerprint(text) == sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > 3)


def test_golay_and_fuzzy_keys():
    pick = np.random.default_rng(0)
    words = pick.integers(0, 2**23, 5000).astype(np.uint32)
    error = golay._errors()[golay.syndrome(words)]
    assert (golay.syndrome(words ^ error) == 0).all() and (np.bitwise_count(error) <= 3).all()
    a = pick.integers(0, 2**63, 5000).astype(np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in pick.choice(64, i % 5, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    left, right = (set(zip(*map(np.ndarray.tolist, fuzzy_keys(x)))) for x in (a, b))
    assert {row for row, _ in left & right} == set(range(len(a)))


def test_near_duplicates(spark, odd, empty, monkeypatch):
    pick = random.Random(2)
    base = ["".join(pick.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    texts = [" ".join(base)] * 5 + ["", None, " "]
    for _ in range(60):  # a cluster of near copies, large enough for blocks
        words = base[:]
        words[pick.randrange(60)] = "zz"
        texts.append(" ".join(words))
    texts += [" ".join(pick.choice(base) for _ in range(40)) for _ in range(40)]
    ids = [i if i % 9 else None for i in range(1, len(texts) + 1)]
    docs = spark.createDataFrame(rows_of(texts, ids), DOCS)
    prints, component, groups = brute_components(texts, ids)
    wanted = sorted(map(str, zip(ids, (f"{p:016x}" for p in prints), component)))
    for block in (1024, 8):
        monkeypatch.setattr(simhash_dedup, "BUCKET", block)
        got = near_duplicates(docs)
        assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got.collect()) == wanted
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, groups))
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0
    assert near_duplicates(odd).count() == odd.count()
    with pytest.raises(ValueError):
        simhash_dedup.links(docs, 5)


def test_spanning_links_connect_the_same():
    prints = np.unique(np.random.default_rng(3).integers(0, 1 << 9, 200).astype(np.uint64))
    a, b = spanning_links(prints, 1)
    assert sum(map(len, a)) < len(prints)
    assert all((np.bitwise_count(x ^ y) <= 1).all() for x, y in zip(a, b))


def test_licenses(spark, odd, empty):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\n"
           "The above copyright notice and this permission notice shall be included in all copies. "
           "The software is provided \"as is\", without warranty of any kind.")
    assert [m[0] for m in scan(f"Some text. {mit} More.")] == ["MIT"]
    assert [m[0] for m in scan("// SPDX-License-Identifier: BSD-2-Clause\nint x;")] == ["bsd-2-clause"]
    assert [m[0] for m in scan("Words. Licensed under the Apache Licence, Version 2.0. All rights reserved.")] == ["Apache-2.0", "all-rights-reserved"]
    assert [m[0] for m in scan("The above copyright notice and this permission notice shall be included.")] == ["unclassified"]
    assert scan("A license to learn, with permission.") == []
    docs = spark.createDataFrame(rows_of([mit, None, "", "Released under the MIT License."], [1, 2, 3, None]), DOCS)
    assert {(r.doc_id, r.license) for r in license_matches(docs).collect()} == {(1, "MIT"), (None, "MIT")}
    assert license_matches(empty).count() == 0 and license_matches(odd).count() == 0


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
THREE
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES, HOWEVER CAUSED.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
}
WRAPPED["BSD-3-Clause"] = WRAPPED["BSD-2-Clause"].replace("THREE", """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""")
WRAPPED["BSD-2-Clause"] = WRAPPED["BSD-2-Clause"].replace("THREE", "")
WRAPPED["GPL-2.0-or-later"] = WRAPPED["GPL-3.0-or-later"].replace("Foundation, either version 3", "Foundation; either version 2")
WRAPPED["LGPL-2.1-or-later"] = (WRAPPED["GPL-2.0-or-later"].replace("version 2", "version 2.1").replace("GNU General", "GNU Lesser General")
                                .replace("This program", "This library"))


@pytest.mark.parametrize("licence", sorted(WRAPPED))
def test_wrapped_licence_texts(licence):
    text = WRAPPED[licence]
    for sign in ("", "// ", "# ", " * ", ";; "):
        commented = "\n".join((sign + line).rstrip() for line in text.split("\n"))
        for around in (commented, f"Some words.\r\n\r\n{commented}\n\nint x;", f"/*\n{commented}\n */\nint main() {{"):
            assert [m[0] for m in scan(around)] == [licence], sign
    assert len(scan(text)[0][3]) >= 3


def test_licence_sentence_ends():
    assert [m[0] for m in scan("Under the\nGNU Lesser General Public License, version\n3. Other words.")] == ["LGPL-3.0"]
    assert [m[0] for m in scan("All rights\nreserved")] == ["all-rights-reserved"]
    assert [m[0] for m in scan("Released under the MIT License\nAll rights reserved")] == ["MIT", "all-rights-reserved"]
    for line, wanted in (("MIT OR Apache-2.0", "mit or apache-2.0"), ("(MIT AND (BSD-3-Clause OR ISC)) */", "(mit and (bsd-3-clause or isc))"),
                         ("GPL-2.0-only WITH Classpath-exception-2.0 // x", "gpl-2.0-only with classpath-exception-2.0"),
                         ("GPL-2.0+ and more", "gpl-2.0+"), ("MIT OR", "mit"), ("(MIT", "mit")):
        assert [m[0] for m in scan(f"/* SPDX-License-Identifier: {line}\nint x;")] == [wanted]


def test_language(spark, odd, empty):
    pick = random.Random(6)
    words = {"en": "the and of is that with for".split(), "de": "der die und nicht mit für auf".split()}
    rows = [(n, " ".join(pick.choice(words[lang]) for _ in range(30)), lang) for n in range(200) for lang in ["en" if n % 2 else "de"]]
    docs = spark.createDataFrame([(n, t, lang, "x", "y") for n, t, lang in rows], "doc_id long, text string, lang string, nearest string, score string")
    model = language_id.fit(docs, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert all(got[n].nearest == lang and 0 <= got[n].score <= 1 for n, _, lang in rows)
    assert model.predict("漢字漢字漢字")[1] == "und"
    none = {r.doc_id: r.nearest for r in language_id.identify(odd.where("doc_id is not null"), model).collect()}
    assert none[1] == none[2] == none[90] == "und" and none[3] in words
    assert language_id.identify(empty, language_id.fit(empty, F.lit(True))).count() == 0
    assert {r.nearest for r in language_id.identify(docs, language_id.fit(empty, F.lit(True))).collect()} == {"und"}


def test_quality(spark, odd, empty):
    pick = random.Random(7)
    rows = [(n, " ".join(pick.choice(["tree", "house", "river", "stone"]) + ("!!" if n % 3 == 0 else "") for _ in range(20))) for n in range(300)]
    docs = spark.createDataFrame(rows_of([t for _, t in rows], [n for n, _ in rows]), DOCS)
    labels = spark.createDataFrame([(n, int(n % 3 != 0)) for n, _ in rows if n % 5] + [(None, 1), (1, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score_documents(docs, model).collect()}
    assert all((got[n] >= 0.3) == (n % 3 != 0) for n, _ in rows if n % 5 == 0)
    kept = quality.keep_good(docs, model, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {n for n, s in got.items() if s >= 0.3}
    assert quality.score_documents(odd, model).count() == odd.count() and quality.score_documents(empty, model).count() == 0
    one = quality.fit(docs, labels.where("quality = 1"))
    assert {round(r.score, 6) for r in quality.score_documents(odd, one).collect()} == {1.0}
    assert quality.score_documents(docs.limit(1), quality.fit(empty, labels.limit(0))).first().score == 0.5
