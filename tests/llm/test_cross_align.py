"""Aligned tokens against whole texts encoded and compared plainly."""

import hashlib
from collections import Counter, defaultdict

import pytest

from foliowright.llm import cross_align
from foliowright.llm.queries import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = [
    "", None, " ", "  ", "\n", "\n\n a", "a\n", "a ", "<|endoftext|> x</s><s>", "a▁b", "▁", "x  y   z", "tab\tx\t y\r\nz \r\n", "é́ ﬁ", "日本語 テキスト\n\n漢字", "᠎  foo  bar",
    "a\x00b\x1c \x1d\x85 q", "it's 'll  don't​ x", "😀😀 👩‍👩‍👧", "x" * 5000, "   lead", "\x1c", "'s 've", "<0x0A> <unk>", "a  \n  b", "nb sp   x", "word " * 4000, "same text", "same text", "x;\r\ny",
]


def plain(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    letters = cross_align._letters()
    docs, counts = [], Counter()

    def spans(tokens):
        out, at = [], 0
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    for t in texts:
        own_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids] if t else []
        own_b = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t)] if t else []
        if not t or not b"".join(x for _, x in own_a) == b"".join(x for _, x in own_b) == (" " + t).encode():
            docs.append(None)
            continue
        own_a, own_b = spans(own_a), spans(own_b)
        starts = defaultdict(list)
        for k, (_, s, e) in enumerate(own_b):
            for byte in range(s, e):
                starts[byte].append(k)
        links = [(i, own_b[k][0]) for i, s, e in own_a for k in sorted({k for byte in range(s, e) for k in starts[byte]})]
        both = sorted({e for *_, e in own_a} & {e for *_, e in own_b})
        groups, last = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for i, s, e in own if last < e <= end) for own in (own_a, own_b)) if len(t) < 1000 else None)
            last = end
        docs.append((len(own_a), len(own_b), groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = d
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
            out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), sha))
    return out


@pytest.mark.parametrize("size,safe", [(10**9, None), (2000, None), (2000, " "), (10**9, "")])
def test_alignments_equal_plain(spark, monkeypatch, size, safe):
    if safe is not None:
        monkeypatch.setattr(cross_align, "cuttable", lambda *paths: safe)
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], "doc_id long, text string, item string, n_a int").repartition(3)
    out = cross_align.align(frame, tokenizer_path(A), tokenizer_path(B), size=size)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out.collect()}
    for i, want in enumerate(plain(texts)):
        assert got[i][:6] == want[:6]
        assert want[6] is None or got[i][6] == want[6]


def test_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert cross_align.align(none, tokenizer_path(A), tokenizer_path(B)).count() == 0
    some = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    rows = cross_align.align(some, tokenizer_path(A), tokenizer_path(B)).collect()
    assert sorted(str((r.doc_id, r.n_a, r.count_sum)) for r in rows) == ["(1, 2, 6)", "(1, 2, 6)", "(2, 0, 0)", "(None, 2, 6)"]


def test_cuts_are_read_off_the_vocabularies():
    assert cross_align.cuttable(tokenizer_path(A), tokenizer_path(B)) == " \n"
    cut = cross_align.cutter(tokenizer_path(A), tokenizer_path(B))
    assert cut("a b\n\nc \t d\re  ") == [" a", " b", "\n\nc", " \t d\re", "  "]
    assert cut("") == []
