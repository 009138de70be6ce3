"""Punctuation is told from words without a regular expression a word."""
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from hrlens.llm import dac

WORDS = ["plain", "end.", "two.,", "x)]}", "...", "", "é!", "日本;", "1%", "a.b", "a-.", "line\nmore.", "<x>.", "say\"", "ß", ">", "tab\t.", "٣:"]


def test_words_are_cut_as_leaves_are(monkeypatch):
    words = WORDS + [f"w{i}{'.,;!'[i % 4] * (i % 3)}" for i in range(500)]
    seen = []
    for name in ("match_substring_regex", "replace_substring_regex"):
        real = getattr(pc, name)
        monkeypatch.setattr(pc, name, lambda a, *r, _f=real, **k: (seen.append(len(a)), _f(a, *r, **k))[1])
    w = dac.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    core, end = w._apart(pa.array(words, pa.large_string()))
    piece = {i: p for p, i in w.known.items()}
    for word, c, e in zip(words, core, end, strict=True):
        found = w.leaves(word) if "\n" not in word else [word]
        assert [piece[c], *([piece[e]] if e >= 0 else [])] == found, word
    assert max(seen) < 50  # different last characters, not words


def test_ids_equal_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    w = dac.WordEncoder(path)
    texts = [" ".join(WORDS), "One, two; three!! (four) 5%.", "a.\nb, c", "", "日本; é! ß.", "x " * 50 + "end."]
    for text, ids in zip(texts, w.encode(texts), strict=True):
        assert ids.tolist() == w.tokenizer.encode(text, add_special_tokens=False).ids
