"""Texts are encoded by runs and pieces; the ids are those of whole texts."""

import random
from array import array

from tidemark.llm import tokens

SIGNS = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "a", "B", "é", "ß", "9", ".", ",", "'s", "'", "’", "—", "¿", "<|endoftext|>", "<|", "|>", "|", "&&&", "$", "#", "%", "_", "~", "[", "@", "\\", "-", "(", "中", "　", "\xa0", "\x1c", " ", "don't", "word", "²"]


def whole(text):
    ids = tokens._tokenizer(tokens.vocabulary_path()).encode(text, add_special_tokens=False).ids
    return array("I", [*ids, tokens.END_ID]).tobytes()


def test_runs_give_the_ids_of_whole_texts():
    draw = random.Random(11)
    texts = ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    assert list(tokens.encode([*texts, None])) == [*map(whole, texts), whole("")]


def test_known_words_are_not_encoded_again(monkeypatch):
    """After a line end, before punctuation: a word that is known there is known in other company."""
    list(tokens.encode(["One quitelongword&&& two.\nAnotherword three #", "some otherword.\nThen", "x %%% y?"]))
    tokens._spaced.clear()
    monkeypatch.setattr(tokens, "_tokenizer", lambda path: None)
    got = list(tokens.encode(["some quitelongword.\nAnotherword otherword&&& two"]))
    monkeypatch.undo()
    assert got == [whole("some quitelongword.\nAnotherword otherword&&& two")]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 5)
    texts = [f"a{i} b{i}, c{i}.\nD{i}" for i in range(20)] * 2
    assert list(tokens.encode(texts)) == list(map(whole, texts))


def test_words_go_to_the_vocabulary_without_its_search_for_words(monkeypatch):
    """Each new word is looked at once and alone; ids are those of whole texts, for every letter of Latin-1 too."""
    letters = [chr(c) for c in range(0xAA, 0x100)]
    words = [f"{a}x{b}" for a, b in zip(letters, reversed(letters), strict=True)] + ["Zebrafinkish", "ñandú", "Straßenzüge"]
    texts = [" ".join(words), "\n".join(words), ". ".join(words), *letters, *words]
    tokens._cache.clear()
    tokens._spaced.clear()
    assert list(tokens.encode(texts)) == list(map(whole, texts))
    known = {p for p in tokens._cache if tokens.WORD.fullmatch(p.removeprefix(" "))}
    assert {"Zebrafinkish", " ñandú", " Straßenzüge"} <= known
    tokens._cache.clear()
    tokens._spaced.clear()

    class Refusing:
        def encode_batch_fast(self, *_, **__):
            raise AssertionError("a plain word was searched for words")

    plain = "Zebrafinkish ñandú Straßenzüge again"
    expected = whole(plain)
    tokens._words(tokens.vocabulary_path())
    with monkeypatch.context() as patched:
        patched.setattr(tokens, "_tokenizer", lambda path: Refusing())
        assert list(tokens.encode([plain])) == [expected]


def test_another_vocabulary_finds_no_ids_of_the_first(tmp_path):
    list(tokens.encode(["hello there"]))
    other = str(tmp_path / "other.json")
    from tokenizers import Tokenizer, models, pre_tokenizers

    small = Tokenizer(models.BPE({c: i for i, c in enumerate(sorted(pre_tokenizers.ByteLevel.alphabet()))}, []))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.save(other)
    ids = small.encode("hello there").ids
    assert list(tokens.encode(["hello there"], other)) == [array("I", [*ids, tokens.END_ID]).tobytes()]
    assert list(tokens.encode(["hello there"])) == [whole("hello there")]
