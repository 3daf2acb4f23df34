import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF0001
from txengine.llm.common import table
from txengine.llm.shared_cuts import AlignOptions, Encoders, alignments, byte_alphabet, shared_cuts


def _spelled():
    o = AlignOptions()
    a, b = Tokenizer.from_file(o.byte_bpe), sentencepiece.SentencePieceProcessor(model_file=o.piece_bpe)
    a.encode_special_tokens = True
    alphabet = byte_alphabet()

    def of_a(i):
        return bytes(alphabet[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>"

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xs, ys = [of_a(i) for i in x], [of_b(i) for i in y]
        return (x, xs, y, ys) if b"".join(xs) == b"".join(ys) == (" " + text).encode() else None

    return both


def _spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def _brute(texts):
    """Groups, links and counts token by token."""
    both, rows, counts = _spelled(), [], Counter()
    for t in texts:
        got = both(t)
        if got is None:
            rows.append((0, 0, 0, [], ""))
            continue
        x, xs, y, ys = got
        sx, sy = _spans(xs), _spans(ys)
        shared = sorted({e for _, e in sx} & {e for _, e in sy})
        links = [(x[i], y[j]) for i, (s, e) in enumerate(sx) for j, (u, v) in enumerate(sy) if s < v and u < e]
        counts.update(links)
        start, shown = 0, []
        for end in shared:
            shown.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, spans) if start <= s and e <= end) for ids, spans in ((x, sx), (y, sy))))
            start = end
        rows.append((len(x), len(y), len(shared), links, hashlib.sha256(";".join(shown).encode()).hexdigest()))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [
        (na, nb, g, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for na, nb, g, links, sha in rows
    ]


ODD = [
    None, "", " ", "  ", "a", " a ", "\n", "\n\n x \t y\r\n", "<|endoftext|> <s> <unk> </s>", "under▁score", "café naïve Über",
    "日本語 の文 \U0001f600!", "é ́x", "it's we'll 'tis", "x" * 300, " " * 50 + "y", "tabs\tand\x0bmore\x0c", "1234567 8,9.0",
    " nbsp 　wide", "\x00nul", "ﬁ ligature ①", "same same same same",
]


@pytest.mark.parametrize("head", [1_000_000, 30, 0])
def test_equals_brute_force(spark, head):
    """Odd texts and real ones; with all pairs, few and none held in the tasks."""
    texts = ODD + [r.text[:700] for r in table(spark, SF0001, "documents").where("text is not null").limit(25).collect()]
    want = _brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_a", "2 as row")
    opts = AlignOptions(head=head, block=3000)
    got = {r.doc_id: r for r in alignments(df.repartition(3), opts).collect()}
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == w, texts[i]
    assert got[0].groups_sha256 == "" and sum(w[0] == 0 for w in want) >= 3


def test_remembered_words_equal_whole_texts(spark):
    enc, both = Encoders(AlignOptions(held=50)), _spelled()
    assert enc.by_word
    texts = ODD + [r.text for r in table(spark, SF0001, "documents").where("text is not null").collect()]
    for text in texts:
        got, want = enc.encode([text])[0], both(text)
        assert (got is None) == (want is None)
        if got:
            assert got[0].tolist() == want[0] and got[1].tolist() == want[2]


def test_cuts_of_random_ends():
    rng = random.Random(3)
    for _ in range(200):
        size = rng.choice([1, 2, 5, 40, 300])
        texts, at, a, b, last = rng.choice([1, 2, 7]), 0, [], [], []
        for _ in range(texts):
            stop = at + size
            for side in (a, b):
                side += sorted(rng.sample(range(at + 1, stop), rng.randrange(0, size))) + [stop]
            last.append(len(a) - 1)
            at = stop
        got = shared_cuts(np.array(a), np.array(b), np.array(last))
        assert got.tolist() == [i for i, e in enumerate(a) if e in set(b)]


def test_long_text_without_a_cut():
    n = 200_000
    a, b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n - 1, 2), 2 * n)
    assert shared_cuts(a, b, np.array([n - 1])).tolist() == [n - 1]


def test_rows_that_repeat_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "to be"), (1, "to be"), (None, "to be"), (2, None)], "doc_id long, text string")
    rows = alignments(df).collect()
    assert len(rows) == 4 and len({r[1:] for r in rows if r.n_a}) == 1
    assert [r.n_a for r in rows if r.doc_id == 2] == [0]
    one = next(r for r in rows if r.n_a)
    assert one.count_sum == 3 * one.n_links
    assert alignments(df.limit(0)).count() == 0
