import itertools
import random

from tokenizers import Tokenizer

from cargoweave.llm import token_codes
from cargoweave.llm.common import WHITE, Memo
from cargoweave.llm.queries import TOKENIZER


def test_pieces_of_odd_strings_are_the_library():
    library, r = Tokenizer.from_file(TOKENIZER), random.Random(5)
    parts = [*"abS12'’.,-|<>\u200bé߀ж中𝒳\u0301\x1c\x7f", *WHITE, "'s", "'ll", "<|endoftext|>", "  ", "\n\n", " the"]
    for _ in range(60):
        texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(50)] + [""]
        got = list(token_codes._encoded(TOKENIZER, texts))
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    for white, before, after in itertools.product(WHITE, "a.é中", ["b", " b", "\nb", ""]):
        text = f"{before}{white}{after}"
        assert next(token_codes._encoded(TOKENIZER, [text])).tolist() == library.encode(text, add_special_tokens=False).ids
    assert list(token_codes._encoded(TOKENIZER, [])) == [] and len(next(token_codes._encoded(TOKENIZER, [""]))) == 0


def test_words_reach_the_library_once(monkeypatch):
    """Whatever punctuation follows them, and in whatever batch they come."""
    handed, plain = [], token_codes._library_ids
    monkeypatch.setattr(token_codes, "_library_ids", lambda path, texts: (handed.extend(texts), plain(path, texts))[1])
    monkeypatch.setattr(token_codes, "_memory", lambda path, memo=Memo(1000): memo)
    r = random.Random(6)
    words = ["".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(50)]
    for _ in range(3):
        text = "".join(f" {w}{e}" for w in words for e in (",", ".", ";", "!"))
        assert next(token_codes._encoded(TOKENIZER, [text])).tolist() == plain(TOKENIZER, [text])[0].tolist()
    assert sum(map(len, handed)) <= 10 * len(words) + 20
