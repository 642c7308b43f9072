import pytest

from popcorr.llm import token_count
from popcorr.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_counts_as_the_library(edge, edge_list, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_count.token_counts(edge, vocabulary_path()).collect())
    want = sorted((d is None, d or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                  for d, t, _, _ in edge_list)
    assert got == want


def test_pieces_of_every_kind(library):
    count = token_count.text_counter(*token_count.load_vocabulary(vocabulary_path()))
    texts = ["".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x3100, 64)]
    texts += ["a" * 5000, " " * 777 + "x", "'s 'll'd", "<|endoftext|><|endoftext|> <|endoftext|", "\x85 \x1c\x1d a　b​c"]
    for t in texts:
        assert count(t) == len(library.encode(t, add_special_tokens=False).ids), repr(t)


def test_merging_takes_the_lowest_rank_first_and_the_leftmost():
    ranks = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2, ("a", "a"): 3}
    assert token_count.count_symbols(list("abc"), ranks) == 1
    assert token_count.count_symbols(list("aaa"), ranks) == 2
    assert token_count.count_symbols(list("xbc"), ranks) == 2
    assert token_count.count_symbols([], ranks) == 0


def test_empty_table(empty):
    assert token_count.token_counts(empty, vocabulary_path()).count() == 0
