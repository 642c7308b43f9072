import hashlib
import random

import numpy as np

from popcorr.llm import induced, suffix_dedup


def test_suffix_arrays_against_sorting():
    rng = np.random.default_rng(1)
    for trial in range(150):
        x = np.append(rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(1, 150))), 0).astype(np.int64)
        if trial % 5 == 0:
            x = np.append(np.tile(x[:-1], 3), 0)
        t = x.tolist()
        assert induced.suffix_array(x, 10**6).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_permuted_prefixes():
    data = np.frombuffer(b"abcdefgh12345678abcdefgh12345678abcdefgh12xx5678" * 3, np.uint8)
    order = induced.suffix_array(np.append(data.astype(np.int64) + 1, 0), 20)
    order = order[order + 20 <= len(data)]
    common = induced.permuted_prefixes(data, order, 20)
    raw = data.tobytes()
    for a, b in zip(order[:-1], order[1:]):
        n = next((k for k in range(20) if raw[a + k] != raw[b + k]), 20)
        assert common[b] == n


def brute(rows):
    """(id, text) -> bytes removed, spans, hash of what is left; ids compared, equal ids do not cover each other."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for p in range(len(b) - 49):
                least[b[p:p + 50]] = min(d, least.get(b[p:p + 50], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for p in range(len(b) - 49):
                if least[b[p:p + 50]] < d:
                    gone[p:p + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d is None, d or 0, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(docs):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(docs).collect())


def test_edge_rows(edge, edge_list):
    want = brute([(d, t) for d, t, _, _ in edge_list])
    assert sum(w[3] for w in want) > 1000
    assert found(edge) == want


def test_small_packs_pieces_blocks_and_joins_change_nothing(edge, edge_list, monkeypatch):
    for name, value in (("PACK_BYTES", 2000), ("PIECE", 700), ("SHARD_BYTES", 20_000), ("ARRAY_BYTES", 3000), ("BROADCAST_BYTES", 0)):
        monkeypatch.setattr(suffix_dedup, name, value)
    assert found(edge) == brute([(d, t) for d, t, _, _ in edge_list])


def test_many_overlapping_copies_of_random_parts(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcd ") for _ in range(400)) for _ in range(4)]
    rows = []
    for i in range(120):
        t = ""
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, 300)
            t += p[a:a + rng.randint(30, 120)] + rng.choice(["", "ab" * 40, "é" * 30])
        rows.append((rng.randint(-50, 50) * 3 + 1 if i % 40 == 0 else i * 2, t))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(docs) == brute(rows)


def test_a_large_shard_is_dealt_by_finer_keys(monkeypatch):
    """a frequent anchor's segments grow with the input, and were worked on all together."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    pool = [word(60) for _ in range(30)]
    rows = [(3 * i, " ".join(rng.choice([rng.choice(pool), word(40), "ab" * 40, "x"]) for _ in range(12))) for i in range(300)]
    raw = [t.encode() for _, t in rows]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    pack = suffix_dedup.Pack(1)
    ids, seen, whole = np.array([d for d, _ in rows]), [], suffix_dedup.shard_spans
    pack.add(ids, np.zeros(len(ids), np.int64), suffix_dedup.segments(data, offsets), data, 0)
    made = [r for b in pack.rows() for r in b.to_pylist()]
    first = [np.frombuffer(r["head"], "<i8").reshape(-1, 4) for r in made if r["kind"] == 1]
    parts = [(r["head"], r["text"], r["n"], r["size"]) for r in made if r["kind"] == 0]
    total = sum(p[3] for p in parts)
    monkeypatch.setattr(suffix_dedup, "shard_spans", lambda *x: seen.append(len(x[4])) or whole(*x))

    def covered():
        spans = suffix_dedup.merged(np.concatenate([*first, *suffix_dedup.part_spans(list(parts))]))
        return spans.tolist()

    want = covered()
    assert seen == [total] and len(want) > 100
    for limit in (20_000, 2_000):
        seen.clear()
        for name in ("SPLIT_BYTES", "ARRAY_BYTES", "RUN_BYTES"):
            monkeypatch.setattr(suffix_dedup, name, limit)
        assert covered() == want
        assert len(seen) > 5 and max(seen) < total // 3
    gone = {d: sum(z - a for i, _, a, z in want if i == d) for d, _ in rows}
    assert sorted(w[3] for w in brute(rows)) == sorted(gone.values())


def test_empty_table(empty):
    assert suffix_dedup.dedup(empty).count() == 0
