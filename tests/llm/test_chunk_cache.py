"""A full cache of chunks keeps what is still met."""

from tabularium.llm import packing
from tabularium.llm.queries import tokenizer_path


def test_common_chunks_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 20_000)
    cached, plain = packing.ChunkEncoder(tokenizer_path()), packing.ChunkEncoder(tokenizer_path())
    asked, made = [], cached._plain
    monkeypatch.setattr(cached, "_plain", lambda chunk: asked.append(chunk) or made(chunk))
    letters = "abcdefghij"
    for i in range(100):
        text = " ".join(["common", "words,", *("".join(letters[int(d)] for d in f"{i * 20 + k:05d}") for k in range(20))])
        assert cached([text]) == [b"".join(plain([w])[0] for w in text.split())]
    assert asked.count("common") == 1 and asked.count("words") == 1
    assert cached.held < 20_000 and len(cached.known) + len(cached.older) < 150
