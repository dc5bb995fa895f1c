from __future__ import annotations

import os
import random

import numpy as np
import pytest

from tillroll.llm import sentencepiece as sp
from llm_fixtures import docs, edge, empty, llm  # noqa: F401

MODEL = sp.DEFAULT_MODEL
needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no tokenizer file")


def lists(enc, texts):
    flat, at = enc.encode_batch(texts)
    return [flat[a:b].tolist() for a, b in zip(at, at[1:])]


@needs_model
def test_equal_to_the_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    enc = sp.encoder(MODEL)
    rng = random.Random(1)
    pieces = list(enc.v.ids)
    texts = ["", " ", "  x", "Hello  world\n a\tb ", "a" * 3000, "-" * 70 + "==", " " * 50 + "x" + " " * 33, "日本語 text 梦 😀 ﬁ é", "\x00"]
    texts += ["".join(rng.choice("abcdeinrstlho  tTH.-_=0123é") for _ in range(rng.randint(1, 300))) for _ in range(400)]
    texts += ["".join(rng.choice(pieces) for _ in range(20)) for _ in range(400)]
    got = lists(enc, texts)
    assert got == lib.encode(texts)
    assert [enc.decode(x) for x in got] == [lib.decode(x) for x in got]


def merged(vocabulary, word):
    return vocabulary.merge_word(word)


def test_bpe_path_is_the_merge_result():
    rng = random.Random(4)
    for trial in range(30):
        letters = "abc"
        pieces = list(letters)
        while len(pieces) < 18:
            p = rng.choice(pieces) + rng.choice(pieces)
            if p not in pieces and len(p) <= 6:
                pieces.append(p)
        # a piece scores no better than those it was made of; ties too.  Every third model is not ordered so
        scores = [-100.0 - k for k in range(3)] + [-float(k // 2 if trial % 3 else rng.randint(0, 8)) for k in range(15)]
        v = sp.Vocabulary(pieces, scores, ["normal"] * len(pieces), unigram=False, dummy_prefix=False)
        words = ["".join(rng.choice(letters) for _ in range(n)) for n in range(1, 14) for _ in range(12)]
        assert [np.frombuffer(x, np.int32).tolist() for x in v.encode_words(words)] == [merged(v, w) for w in words], trial


def test_unigram_path_has_the_best_score():
    rng = random.Random(5)
    pieces = [*"ab", "aa", "ab", "ba", "aab", "bab", "abab"]
    scores = [rng.uniform(-5, -0.1) for _ in pieces]
    v = sp.Vocabulary(pieces, scores, ["normal"] * len(pieces), unigram=True, dummy_prefix=False)

    def best(word):
        top = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            top[e] = max(top[s] + scores[pieces.index(word[s:e])] for s in range(e) if word[s:e] in pieces)
        return top[-1]

    for word in ["".join(rng.choice("ab") for _ in range(n)) for n in range(1, 20)]:
        ids = np.frombuffer(v.encode_words([word])[0], np.int32)
        assert "".join(pieces[i] for i in ids) == word and abs(sum(scores[i] for i in ids) - best(word)) < 1e-9


@needs_model
def test_columns_and_edges(edge, empty, docs):
    got = sp.encode(edge).collect()
    assert len(got) == edge.count() and all(r.round_trip for r in got) and all(r.n_pieces == len(r.piece_ids) for r in got)
    assert sp.encode(empty).count() == 0
    clash = docs([(1, "a b", "x", 2)], "doc_id long, text string, piece_ids string, n_pieces int")
    back = sp.decode(sp.encode(clash)).collect()
    assert back[0].decoded == "a b" and back[0].n_pieces == len(back[0].piece_ids)


@needs_model
def test_a_small_word_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(sp, "CACHE", 10)
    enc, texts = sp.Encoder(sp.load(MODEL)), [f"some word {i % 17} again {i}" for i in range(200)]
    assert [x for i in range(0, 200, 7) for x in lists(enc, texts[i : i + 7])] == lists(sp.encoder(MODEL), texts)


class Unwalked(dict):
    """A memory that may be asked for words, not walked from end to end."""

    def keys(self):
        raise AssertionError("walked")

    __iter__ = items = values = keys


@needs_model
def test_a_batch_does_not_walk_the_word_memory():
    enc = sp.Encoder(sp.encoder().v)
    texts = ["a word met before", "", "two words, before"]
    flat, at = enc.encode_batch(texts)
    enc.recent, enc.older = Unwalked(enc.recent), Unwalked(enc.older)
    again, ends = enc.encode_batch([*texts, "one that was not"])
    assert again[: len(flat)].tolist() == flat.tolist() and ends[: len(at)].tolist() == at.tolist()
    assert enc.decode(again[ends[-2] :].tolist()) == "one that was not"


def test_pieces_are_found_among_many_with_equal_leading_bits(monkeypatch):
    monkeypatch.setattr(sp, "INDEX_BITS", 3)
    words = ["a", "b", "ab", "abc", "ca", "▁a", "▁ab"]
    v = sp.Vocabulary(words, [-float(i) for i in range(len(words))], ["normal"] * len(words), unigram=True)
    asked = [*words, "c", "bc", "▁", "abca"]
    hashes = np.array([v._hash(w) for w in asked] + [0, 2**64 - 1], np.uint64)
    assert v.lookup(hashes).tolist() == [*range(len(words)), *[-1] * 6]


@needs_model
def test_remembered_words_fit_a_worker():
    import sys

    rng = random.Random(8)
    enc = sp.Encoder(sp.load(MODEL))
    text = " ".join("".join(rng.choice(["er", "in", "the", "tion", "an", "sh", "ou"]) for _ in range(rng.randint(1, 5))) for _ in range(4000))
    lists(enc, [text])
    assert len(enc.recent) > 1000
    # the word, its ids and its share of the table; words are kept twice, in recent and in older
    mean = sum(sys.getsizeof(w) + sys.getsizeof(ids) + 50 for w, ids in enc.recent.items()) / len(enc.recent)
    assert 2 * sp.CACHE * mean < 100e6
