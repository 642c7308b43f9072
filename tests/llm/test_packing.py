import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from popcorr.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_decompose():
    for limit in (1, 8, 2048):
        for n in range(1, 5000, 7):
            d = P.decompose(n, limit)
            assert sum(d) == n and d == sorted(d, reverse=True) and all(x & (x - 1) == 0 and x <= limit for x in d)
            assert len([x for x in d if x < limit]) == len({x for x in d if x < limit})


def test_ids_equal_the_library_on_odd_texts(library):
    rng = random.Random(3)
    parts = [chr(i) for a, b in ((0, 0x180), (0x300, 0x330), (0x1680, 0x1681), (0x2000, 0x2070), (0x3000, 0x3010), (0x1100, 0x1110),
                                 (0x1F600, 0x1F610), (0xAC00, 0xAC10)) for i in range(a, b)]
    parts += ["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "\t", "'s", "'S", "É", "İ", "word", "Word", "J\u030c", "I\u0307", "T\u0308", "ΟΔΟΣ", "Σ", "\u212a", "\x01", "word,", "Word.", "é,", "»,", "a).", "<|ENDOFTEXT|>"] * 8
    words = P.WordIds(PATH)
    assert words.apart
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        got = [i for b in words.blocks(text.encode()) for i in b]
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, texts, library, limit=2048):
    """Every document's pieces give back its ids; sequences are gapless, of one piece, by bucket."""
    left = [(i, whole(library, t)) for i, t in texts]
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for i, ids in left:
        want = P.decompose(len(ids), limit)
        start = np.concatenate(([0], np.cumsum(want)))[:-1]
        for s, n in zip(start, want):
            crc = zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())
            own = next(r for r in by_doc[i, len(ids)] if (r.start, r.length, r.ids_crc32) == (s, n, crc))
            by_doc[i, len(ids)].remove(own)
    assert not any(by_doc.values())
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and {r.offset for r in rows} <= {0}
    inorder = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.length for r in inorder] == sorted(r.length for r in rows)
    for b in {r.bucket for r in rows}:
        own = [r for r in inorder if r.bucket == b]
        assert {r.length for r in own} == {1 << b} and [r.place for r in own] == list(range(len(own)))


def test_pieces_of_every_row(spark, edge, edge_list, library):
    rows = P.pack(edge, PATH).collect()
    check(rows, [(i, t) for i, t, *_ in edge_list], library)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    small = P.number(P.pieces(edge, PATH, limit=8, keep_ids=False)).collect()
    check(small, [(i, t) for i, t, *_ in edge_list], library, 8)


def test_blocks_and_tables_change_nothing(spark, edge, edge_list, library, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 50)
    monkeypatch.setattr(P, "TABLE_WORDS", 30)
    monkeypatch.setattr(P, "TABLE_BYTES", 500)
    words = P.WordIds(PATH)
    shrunk = []
    monkeypatch.setattr(words, "shrink", lambda f=words.shrink: (f(), shrunk.append(len(words.place))))
    for _, text, *_ in edge_list * 2:
        assert [i for b in words.blocks((text or "").encode()) for i in b] == whole(library, text)[:-1]
    assert max(shrunk) > 0


def test_files_of_buckets(spark, edge, tmp_path):
    out = P.pack(edge, PATH)
    P.write_buckets(out, str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed"))
    assert back.count() == out.count() and back.where("length <> shiftleft(1, bucket)").count() == 0


def test_empty(spark, empty):
    assert P.pack(empty, PATH).count() == 0
