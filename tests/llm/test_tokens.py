import random

import pytest
from tokenizers import Tokenizer, models

import llm_data
from rareclass.llm import tokens as K


def unigram(pieces, byte_fallback):
    vocab = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *pieces.items()]
    return vocab, Tokenizer(models.Unigram(vocab, 0, byte_fallback))


def brute(pieces, text):
    """Best sum over all segmentations; unknown characters one by one."""
    low = min(pieces.values()) - K.UNKNOWN_PENALTY
    best = {0: 0.0}
    for e in range(1, len(text) + 1):
        best[e] = max(best[s] + (pieces.get(text[s:e], low if e - s == 1 else float("-inf"))) for s in range(e))
    return best[len(text)]


def test_score_is_the_best_of_all_segmentations():
    rng = random.Random(1)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))): -float(rng.randint(1, 6)) for _ in range(12)}
        model = K.CountingViterbi(pieces)
        for _ in range(10):
            text = "".join(rng.choice("abc d") for _ in range(rng.randint(1, 12)))
            assert model.count(text)[1] == brute(pieces, "▁" + text.replace(" ", "▁"))


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_counts_equal_a_public_tokenizer_with_ties(byte_fallback):
    """Whole-number scores make many ties; the library's own unigram walk gives the count to match."""
    rng = random.Random(2)
    for n in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -float(rng.randint(1, 3)) for _ in range(9)}
        pieces |= {"▁": -2.0, "▁a": -3.0, "a": -1.0}
        vocab = [("<unk>", 0.0), *pieces.items()]
        if byte_fallback:
            vocab += [(f"<0x{b:02X}>", min(pieces.values())) for b in range(256)]
        ref = Tokenizer(models.Unigram(vocab, 0, byte_fallback))
        model = K.CountingViterbi(pieces, byte_fallback)
        for _ in range(10):
            text = "".join(rng.choice("abc aé中" if byte_fallback else "abc a") for _ in range(rng.randint(1, 15)))
            ids = ref.encode("▁" + text.replace(" ", "▁")).ids
            if byte_fallback or 0 not in ids:
                assert model.count(text)[0] == len(ids), (pieces, text)


def test_public_vocabulary_on_documents(spark):
    """The vocabulary of the production run, through the tokenizers library, over whole texts."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=K.MODEL_FILE)
    pieces = {sp.IdToPiece(i): sp.GetScore(i) for i in range(sp.GetPieceSize()) if not (sp.IsControl(i) or sp.IsUnknown(i) or sp.IsByte(i))}
    low = min(pieces.values())
    ref = Tokenizer(models.Unigram([("<unk>", low), *pieces.items(), *[(f"<0x{b:02X}>", low) for b in range(256)]], 0, True))
    rows = llm_data.rows()
    got = {}
    for r in K.token_counts(llm_data.docs(spark)).collect():
        got[r["doc_id"]] = r
    assert len(got) == len({r[0] for r in rows})
    for doc, text, *_ in rows:
        want = len(ref.encode("▁" + text.replace(" ", "▁")).ids) if text else 0
        assert got[doc]["n_tokens"] == want and got[doc]["n_chars"] == len(text or "")
    assert K.token_counts(llm_data.empty(spark)).count() == 0


def test_stretches_without_spaces_and_uncuttable_vocabularies():
    pieces = {"a": -1.0, "ab": -1.5, "b▁a": -0.5, "▁": -1.0, "b": -1.0}
    model = K.CountingViterbi(pieces)
    assert not model.cuttable
    assert model.count("ab ab")[1] == brute(pieces, "▁ab▁ab")
    assert K.CountingViterbi({"a": -1.0}).count("a" * 100_000)[0] == 100_000 + 3  # the mark in front is three unknown bytes
