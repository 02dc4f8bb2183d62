"""Token alignment against whole-text encoding and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from catalith.llm import alignment, kernel

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROWS = "doc_id long, text string"


def thue_morse():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


def plain(texts):
    """Rows of every text by encoding it whole and comparing all byte ranges."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    back = {c: b for c, b in alignment.byte_alphabet().items()}

    def piece(i):
        return bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()

    found = []
    for text in texts:
        a = b = []
        if text:
            want = (" " + text).encode()
            a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            joined = [bytes(back[c] for c in one.id_to_token(i)) for i in a], [piece(i) for i in b]
            if b"".join(joined[0]) != want or b"".join(joined[1]) != want:
                a = b = []
        spans = []
        for side in joined if a else ([], []):
            ends = np.cumsum([len(x) for x in side]).tolist()
            spans.append(list(zip([0, *ends], ends, strict=False)))
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (p, q) in enumerate(spans[1]) if s < q and p < e]
        both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, i, j = [], 0, 0
        for end in sorted(both):
            p, q = 1 + [e for _, e in spans[0]].index(end), 1 + [e for _, e in spans[1]].index(end)
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    held = Counter(p for f in found for p in set(f[3]))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    rows = [(n_a, n_b, n, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), d) for n_a, n_b, n, links, d in found]
    return rows, held, Counter(p for f in found for p in f[3])


ODD = ["", None, " ", "  ", "\n", " a", "a ", "a\nb", "a\n\nb c", "x  y", "x▁y", "a ▁ b", "a▁ b", " x", "é ü\nß", "<|endoftext|> </s> <s>", "日本 語\n한국 x", "🙂 🙃", "\x00 q", "it's we'll", "é f", "tab\there\r\nnext", "a​b c", "　 z", "ﬁ ½"]


def check(spark, texts, parts=3):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ROWS).repartition(parts)
    got = {r.doc_id: r for r in alignment.align(df, A, B).collect()}
    rows, held, times = plain(texts)
    assert sorted(got) == list(range(len(texts)))
    for i, want in enumerate(rows):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want, texts[i]
    return df, held, times


def test_equals_plain_counting(spark, monkeypatch):
    rng = random.Random(3)
    words = ["the", "Stanford", "unbelievable", "naïve", "данные", "x1", "foo.bar", "...", "don't", "MixedCase", "été", "12345"]
    texts = ODD + [rng.choice(["", " "]).join(["x"] * 3) + " " + "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\n\n", "\t"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [*thue_morse(), "the " * 300, "the " * 300]
    df, held, times = check(spark, texts)
    index = alignment.blocks(df, A, B)
    total = alignment.pairs(alignment.totals(alignment.counted(index, 5)))
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in total.collect()} == {p: (n, times[p]) for p, n in held.items()}


def test_small_blocks_and_forgotten_segments(spark, monkeypatch):
    tool = alignment.Aligner(A, B)
    texts = [f"word{i % 7} other{i % 3} the end{i}" for i in range(50)]
    whole = [x for _, _, x in tool.align(kernel.pa.array(texts))]
    monkeypatch.setattr(alignment, "KEEP", 5)
    again = [x for t in texts for _, _, x in tool.align(kernel.pa.array([t]))]
    assert whole[0].digests == [d for x in again for d in x.digests]
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 4)
    parts = list(tool.align(kernel.pa.array(texts + [""] * 9)))
    assert [j - i for i, j, _ in parts][:3] == [4, 4, 4] and parts[-1][1] == 59


@pytest.mark.parametrize("seed", range(3))
def test_postings(seed):
    rng = np.random.default_rng(seed)
    times = rng.integers(0, 9, (40, 300)) * (rng.random((40, 300)) < 0.2)
    key, doc = np.nonzero(times)
    pairs = (key.astype(np.uint64) * np.uint64(7)) << np.uint64(16) | doc.astype(np.uint64)
    made = alignment.Postings.unpacked(alignment.Postings.build(pairs, times[key, doc]).packed())
    used = np.unique(key)
    assert (made.keys == used * 7).all()
    docs, links = made.counts()
    assert (docs == (times > 0).sum(axis=1)[used]).all() and (links == times.sum(axis=1)[used]).all()
    score = rng.integers(0, 100, (len(used), 2))
    assert (made.sums(score, 300) == times[used].T @ score).all()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], ROWS)
    assert alignment.align(empty, A, B).count() == 0
    nothing = spark.createDataFrame([(None, None), (1, ""), (1, "")], ROWS)
    rows = alignment.align(nothing, A, B).collect()
    assert len(rows) == 3 and all(r.n_links == 0 and r.groups_sha256 == "" for r in rows)
    clash = spark.createDataFrame([(5, "one two", 1, "x", "y"), (5, "one two", 2, "x", "y"), (None, "one", 3, "x", "y")], "doc_id long, text string, block long, keys string, bucket string")
    rows = alignment.align(clash, A, B).collect()
    assert sorted((r.doc_id or -1, r.count_sum) for r in rows) == [(-1, 3), (5, 5), (5, 5)]
