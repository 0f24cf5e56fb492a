"""A block's texts are split and looked up a slab at a time, with the same ids and less memory."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cairn.llm import bpe, tokenfiles, words


def test_slabs_give_the_ids_of_whole_texts(monkeypatch):
    texts = pa.array([t.encode() for t in ("one two  three", "", "été un two", "  odd\n\n spaces ", "three " * 50, "x")])
    for split in (bpe.split, tokenfiles.split):
        whole = split(texts)
        want = [[whole.distinct[k] for k in p] for p in np.split(whole.places, np.cumsum(whole.sizes)[:-1])]
        for slab, many in ((1, 1), (20, 3), (1 << 20, 1 << 20)):
            monkeypatch.setattr(words, "SLAB", slab)
            monkeypatch.setattr(words, "LOOKED_UP", many)
            s = words.by_slab(split, texts)
            assert len({*s.distinct}) == len(s.distinct)
            assert [[s.distinct[k] for k in p] for p in np.split(s.places, np.cumsum(s.sizes)[:-1])] == want
            codes = [np.arange(len(w), dtype=words.ID).tobytes() for w in s.distinct]
            assert words.looked_up(s, codes) == [b"".join(np.arange(len(w), dtype=words.ID).tobytes() for w in p) for p in want]
    none = words.by_slab(bpe.split, texts.slice(0, 0))
    assert not none.distinct and words.looked_up(none, []) == []


def test_looking_up_takes_memory_for_a_slab_only():
    s = words.Split([b"a", b"b"], np.tile(np.arange(2, dtype=np.int32), 1_500_000), np.full(3_000, 1_000, np.int64))
    tracemalloc.start()
    ids = words.looked_up(s, [b"\1\0", b"\2\0\3\0"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, ids)) == 9_000_000 and peak < 40_000_000
    assert ids[7] == b"\1\0\2\0\3\0" * 500


def test_letters_are_shown_as_the_library_shows_them():
    from tokenizers import Tokenizer

    show = Tokenizer.from_file(tokenfiles.TOKENIZER).pre_tokenizer.pre_tokenize_str
    for w in filter(str.isalpha, map(chr, range(0x80, 0x250))):
        assert "".join(p for p, _ in show(w)) == w.encode().decode("latin-1").translate(tokenfiles._SHOWN)
