import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from atrium.llm import bpe_lexicon as B
from atrium.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_transducer(tmp_path):
    words = {w: [i, len(w)] for i, w in enumerate([b"a", b"ab", b"abc", b"xbc", b"zing", b"ring", "né".encode()])}
    (tmp_path / "x").write_bytes(compile_lexicon(words))
    x = Lexicon(str(tmp_path / "x"))
    asked = [*words, b"b", b"abcd", b"zin", b"xab", b"\xff"]
    raw = b"".join(asked)
    sizes = np.array([len(w) for w in asked])
    rank = x.lookup(np.frombuffer(raw, np.uint8), np.cumsum(sizes) - sizes, sizes)
    for w, r in zip(asked, rank.tolist()):
        assert (r >= 0) == (w in words)
        if r >= 0:
            assert x.flat[x.offsets[r] : x.offsets[r] + x.lengths[r]].tolist() == words[w]
    # The endings -ing and -bc are shared.
    assert len(x.final) < sum(map(len, words)) - 3


def test_encoding_is_the_library(tmp_path):
    random.seed(3)
    signs = [*" \n\t'sSdéÉ1²漢!?<|İıß“-rvelmΣς", "e\u0301", "'re", "'LL", "<|endoftext|>", "the", "ing"]
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 30))) for _ in range(2000)] + ["a<|endoftext|>b<|startoftext|>", "", "aaaa" * 500, "ab" * 400]
    some = [b"the", b"ing", b"s", b"wing"]
    (tmp_path / "x").write_bytes(compile_lexicon(dict(zip(some, B.rules(PATH).merge(some)))))
    e, plain = B.Encoder(PATH, str(tmp_path / "x")), Tokenizer.from_file(PATH)
    got = e.encode(texts)
    assert [g.tolist() for g in got] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert [e.decode(g).decode() for g in got] == [plain.decode(g.tolist(), skip_special_tokens=False) for g in got]


def _want(rows):
    plain = Tokenizer.from_file(PATH)
    out = Counter()
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids
        out[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    return out


def test_round_trip(docs, odd_docs, no_docs):
    for d in (docs, odd_docs, no_docs):
        got = Counter(tuple(r) for r in B.bpe_round_trip(d, PATH).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
        assert got == _want([(r["doc_id"], r["text"]) for r in d.collect()])


def test_ids(docs):
    some = docs.where("doc_id < 20")
    plain = Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    for r in B.encoded(some, PATH, B.build_lexicon(some, PATH, 100)).collect():
        assert r["ids"] == plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids
