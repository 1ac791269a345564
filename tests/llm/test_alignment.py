"""Tokenizer alignment against whole encodings by both libraries and links of all pairs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from nickmap.llm import alignment
from nickmap.llm.alignment import Fragment, Tokens, closed, compose, fragment_of
from nickmap.llm.common import table
from nickmap.llm.tokens import tokenizer_path
from tests.llm.test_operators import documents, empty

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a", " a  b ", "x▁y", "▁", "tabs\tand\nlines \n end", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 \x1c \x85 z", "日本語 と 中文字", "🙂🙃 é é ﬁ", "a b c", "0x" * 40, "don't we'll I'm", "Ａ ｂ", "==== ---- ####"]


def both():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(shown)))}
    of_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, of_a, of_b


def plain(docs):
    """Groups and links of each text by comparing all ranges, and the row that results."""
    a, b, of_a, of_b = both()
    found, holds = [], Counter()
    for doc_id, text in docs:
        groups, links, ia, ib = [], [], [], []
        if text:
            ia, ib, own = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
            if b"".join(map(of_a, ia)) != own or b"".join(map(of_b, ib)) != own:
                ia, ib = [], []
            ea, eb = np.cumsum([len(of_a(i)) for i in ia]).tolist(), np.cumsum([len(of_b(i)) for i in ib]).tolist()
            sa, sb = [0, *ea][:-1], [0, *eb][:-1]
            links = [(x, y) for x, s, e in zip(ia, sa, ea) for y, p, q in zip(ib, sb, eb) if s < q and p < e] if len(text) < 3000 else None
            if links is None:
                links, k = [], 0
                for x, s, e in zip(ia, sa, ea):
                    while eb[k] <= s:
                        k += 1
                    m = k
                    while m < len(ib) and sb[m] < e:
                        links.append((x, ib[m]))
                        m += 1
            last = 0
            for cut in sorted(set(ea) & set(eb)):
                part = lambda ids, ends, lo=last, hi=cut: ",".join(str(i) for i, e in zip(ids, ends) if lo < e <= hi)
                groups.append((part(ia, ea), part(ib, eb))) if len(text) < 3000 else None
                last = cut
            if len(text) >= 3000:
                cuts = sorted(set(ea) & set(eb))
                cut_up = lambda ids, ends: [",".join(map(str, ids[i:j])) for i, j in zip([0, *np.searchsorted(ends, cuts, "right")], np.searchsorted(ends, cuts, "right"))]
                groups = list(zip(cut_up(ia, ea), cut_up(ib, eb)))
        holds.update(set(links))
        found.append((doc_id, len(ia), len(ib), ";".join(f"{x}|{y}" for x, y in groups), len(groups), links))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    return sorted(((i, na, nb, n, len(links), sum(holds[p] == most[p[0]] for p in links), sum(holds[p] for p in links), groups) for i, na, nb, groups, n, links in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", df.columns[-1]).collect()), key=str)


def test_query(spark, small):
    docs = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    want = sorted(((*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in plain(docs)), key=str)
    assert got(alignment.op11_alignment(spark, small)) == want


def test_odd_rows(spark):
    odd = documents(spark, [(k, t, "s") for k, t in enumerate(ODD)] + [(1, "a", "s"), (None, "a b", None)])
    docs = odd.unionByName(documents(spark))
    out = alignment.align_tokens(docs, A, B)
    assert got(out) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.n_groups for r in out.where("doc_id in (6, 7) and n_a = 0").collect()} == {6: 0, 7: 0}


def test_empty(spark):
    assert alignment.align_tokens(empty(spark), A, B).count() == 0


def test_long_documents_by_ranges(spark, monkeypatch):
    """All documents as long ones: their ranges are cut within words, and composed over several levels."""
    monkeypatch.setattr(alignment, "RANGE", 40)
    monkeypatch.setattr(alignment, "FAN", 3)
    rng = random.Random(3)
    texts = ["".join(rng.choices(["wort ", "é", " ", "日本", "x" * 30, "tion", "\n", "🙂"], k=rng.randint(1, 400))) for _ in range(12)] + ["y" * 3000, "z" * 500 + " " + "w" * 700, "a  b" * 100, "bad ▁ " * 60]
    docs = [(k, t) for k, t in enumerate(texts + texts[:2])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(alignment.Aligner.ranges, "__defaults__", (40, 25))
    blocks = alignment._long(df, A, B, False)
    assert blocks.count() == len(docs)
    assert got(alignment.align_tokens(df, A, B)) == plain(docs)


@pytest.mark.parametrize("size,near", [(1, 1), (5, 3), (16, 40), (64, 8), (10_000, 10)])
def test_ranges_meet(size, near):
    """Ranges follow one another byte by byte, and their fragments make the whole text's."""
    al = alignment.aligner(A, B)
    for text in [*filter(None, ODD), "some words of several lengths " * 5, "unbroken" * 30, " lead", "trail "]:
        cuts = list(al.ranges(text, size, near))
        assert [c[2] for c in cuts] == [0, *[c[3] for c in cuts][:-1]] and cuts[-1][3] == len(f" {text}".encode())
        f = Fragment()
        for c in cuts:
            f = compose(f, al.fragment(*c), al.width)
        whole, joined = al.whole(text), closed(f, al.width)
        assert (whole.groups, whole.n_groups, whole.n_a, whole.n_b, whole.same) == (joined.groups, joined.n_groups, joined.n_a, joined.n_b, joined.same)
        assert whole.codes.tolist() == joined.codes.tolist() and whole.counts.tolist() == joined.counts.tolist()


def test_monoid():
    """Any cuts and any bracketing give the same fragment, for tokens of any lengths."""
    rng = random.Random(11)

    def same(f, g):
        flat = lambda x: [y.tolist() if hasattr(y, "tolist") else y for z in x for y in (z if isinstance(z, Tokens) else [z])]
        return flat(f) == flat(g)

    for _ in range(150):
        n = rng.randint(1, 40)
        ends = lambda n=n: np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}), np.int64)
        ea, eb = ends(), ends()
        t = Tokens(np.arange(len(ea)), ea, np.arange(len(eb)) + 5, eb)
        cuts = sorted(rng.choices(range(n + 1), k=rng.randint(0, 6)))
        parts = [fragment_of(t.within(x, y), 100) for x, y in zip([-1, *cuts], [*cuts, n], strict=True)]
        whole = fragment_of(t, 100)
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [compose(parts[k], parts[k + 1], 100)]
        assert same(parts[0], whole) and same(compose(Fragment(), whole, 100), whole) and same(compose(whole, Fragment(), 100), whole)
        done = closed(whole, 100)
        assert done.counts.sum() == len(ea) + len(eb) - done.n_groups
