import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from popcorr.llm import pair_bitmaps as P
from popcorr.llm.token_count import byte_symbols

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Whole texts through both libraries, groups and links by the definition."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.back = {s: b for b, s in byte_symbols().items()}

    def bytes_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        e = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.back[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = [(i, self.bytes_b(i)) for i in self.b.encode(text)]
        if not b"".join(x for _, x in a) == (" " + text).encode() == b"".join(x for _, x in b):
            return []
        ends_a, ends_b = (np.cumsum([len(x) for _, x in s]).tolist() for s in (a, b))
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            out.append(([k for k, _ in a[i:x]], [k for k, _ in b[j:y]]))
            i, j = x, y
        return out

    def rows(self, docs):
        links = [Counter((x, y) for ga, gb in self.groups(t) for x in ga for y in gb) for _, t in docs]
        count = Counter(p for c in links for p in c)
        top = defaultdict(int)
        for (x, _), n in count.items():
            top[x] = max(top[x], n)
        out = []
        for (i, t), c in zip(docs, links):
            g = self.groups(t)
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
            out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                        sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()),
                        hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return out, {(*p, n, n == top[p[0]]) for p, n in count.items()}


@pytest.fixture(scope="module")
def plain():
    return Plain()


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_equals_whole_texts(spark, edge, edge_list, plain):
    rows, pairs = P.alignment(edge, A, B)
    want, want_pairs = plain.rows([(i, t) for i, t, *_ in edge_list])
    assert rows.columns == COLUMNS
    assert Counter(tuple(r) for r in rows.collect()) == Counter(want)
    assert {tuple(r) for r in pairs.collect()} == want_pairs and pairs.count() == len(want_pairs)


def test_small_blocks_tables_and_joined_counts(spark, edge, edge_list, plain, monkeypatch):
    for name, value in (("BLOCK_DOCS", 64), ("BITS_BYTES", 8), ("BLOCK_POSTINGS", 300), ("BLOCK_CHARS", 40), ("TABLE_UNITS", 50),
                        ("BROADCAST_PAIRS", 0), ("UNIT_CHARS", 9)):
        monkeypatch.setattr(P, name, value)
    P.unit_table.cache_clear()
    table = P.UnitTable(A, B)
    for _, t, *_ in edge_list:
        own, parts = P.align(table, t)
        g = plain.groups(t)
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        assert own[:3] == (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g))
        assert own[4] == (hashlib.sha256(text.encode()).hexdigest() if g else "")
        want = Counter((x * P.SHIFT + y) for ga, gb in g for x in ga for y in gb)
        got = Counter()
        for p, n in parts:
            for k, m in zip(p.tolist(), n.tolist()):
                got[k] += m
        assert got == want


def test_joined_counts(spark, edge, edge_list, plain, monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_PAIRS", 0)
    rows, _ = P.alignment(edge.repartition(13), A, B)
    assert Counter(tuple(r) for r in rows.collect()) == Counter(plain.rows([(i, t) for i, t, *_ in edge_list])[0])


def test_units_do_not_depend_on_neighbours(plain):
    table, rng = P.UnitTable(A, B), random.Random(8)
    odd = [chr(i) for a, b in ((0, 0x180), (0x300, 0x330), (0x2000, 0x2070), (0x2580, 0x2583), (0x3000, 0x3005), (0x1F600, 0x1F610)) for i in range(a, b)]
    odd += [" ", "  ", "   ", "\n", "\t ", "'s", "don't", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "word", "the", "12"] * 12
    none = 0
    for _ in range(3000):
        text = "".join(rng.choice(odd) for _ in range(rng.randint(0, 20)))
        own, _ = P.align(table, text)
        g = plain.groups(text)
        none += bool(text) and not g
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        assert own[4] == (hashlib.sha256(text.encode()).hexdigest() if g else "")
    assert none


def test_long_run_without_common_ends():
    pairs, links = P.linked([5] * 3000 + [6] * 1000, [9] * 2000)
    assert dict(zip(pairs, links)) == {5 * P.SHIFT + 9: 6_000_000, 6 * P.SHIFT + 9: 2_000_000}


def test_bitmaps():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (10, 4000), (5000, 20), (30_000, 60_000), (65_536, 1)):
        x, y = (np.sort(rng.choice(65_536, k, replace=False)) for k in (n, m))
        bx, by = P.to_bitmap(x), P.to_bitmap(y)
        assert P.from_bitmap(bx).tolist() == x.tolist() and P.popcount(bx) == n
        both = P.merge_bitmaps(bx, by)
        assert P.from_bitmap(both).tolist() == np.union1d(x, y).tolist() and P.popcount(both) == len(np.union1d(x, y))
        which, at = P.from_bitmaps(pa.array([bx, by, bx], pa.binary()))
        assert sorted(zip(which.tolist(), at.tolist())) == sorted((i, v) for i, s in enumerate((x, y, x)) for v in s.tolist())


def test_postings_and_planes():
    rng = random.Random(2)
    rows = [(rng.randint(0, 30), rng.randint(0, 9000), rng.choice([1, 1, 2, 5, 70])) for _ in range(40_000)] + [(99, d, 1) for d in range(50_000)]
    want = Counter()
    for p, d, n in rows:
        want[p, d] += n
    pair, count, bitmaps, planes = P.postings(*P.summed(*(np.array(c, np.int64) for c in zip(*rows))))
    got = {}
    for p, n, docs, pl in zip(pair.tolist(), count.tolist(), bitmaps.to_pylist(), planes.to_pylist()):
        held = P.from_bitmap(docs).tolist()
        assert P.popcount(docs) == n == len(held)
        merged = b""
        for raw in pl:
            merged = P.merge_bitmaps(merged, raw)
        assert not pl or P.from_bitmap(merged).tolist() == held           # the OR of the planes is the bitmap
        for d in held:
            got[p, d] = 0 if pl else 1
        for k, raw in enumerate(pl):
            for d in P.from_bitmap(raw).tolist():
                got[p, d] += 1 << k
    assert got == want


def test_empty(spark, empty):
    rows, pairs = P.alignment(empty, A, B)
    assert rows.count() == 0 and pairs.count() == 0
