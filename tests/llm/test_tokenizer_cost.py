"""What the tokenizer does for each distinct word."""

from tickloom.llm import sentencepiece_bpe


def test_words_that_the_table_covers_are_not_decoded_again(monkeypatch):
    t = sentencepiece_bpe.Tokenizer(sentencepiece_bpe.default_model())
    decoded, plain = [], t._bytes
    monkeypatch.setattr(t, "_bytes", lambda ids: decoded.append(1) or plain(ids))
    text = " ".join(f"word{k} and some more" for k in range(50))
    assert t.encode_decode(text)[2] == text and not decoded
    assert t.encode_decode("☃   x")[2] == "☃   x" and decoded  # bytes and runs of spaces still are


def test_a_text_goes_over_several_generations_of_words(monkeypatch):
    t, small = (sentencepiece_bpe.Tokenizer(sentencepiece_bpe.default_model()) for _ in range(2))
    text = " ".join(f"a{k % 70}b" for k in range(400))
    want = t.encode_decode(text)
    monkeypatch.setattr(sentencepiece_bpe, "CACHE", 20)
    assert small.encode_decode(text) == want and len(small.words) <= 20
