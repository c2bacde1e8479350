"""Token alignment against whole texts encoded one by one and all pairs of their tokens."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyboard.llm import token_alignment as T
from tallyboard.llm.queries import TOKENIZERS, op12_token_alignment

BPE, PIECES = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def encoders():
    letters = T._byte_letters()
    a = Tokenizer.from_file(BPE)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def of_a(text):
        return [(i, bytes(letters[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def of_b(text):
        return [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]

    return of_a, of_b


def plain(rows, encoders):
    spans, links = [], []
    for _, text in rows:
        sides = []
        for encode in encoders:
            at, own = 0, []
            for i, piece in encode(text) if text else []:
                own.append((i, at, at + len(piece), piece))
                at += len(piece)
            sides.append(own)
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(p for *_, p in own) != whole for own in sides):
            sides = [[], []]
        spans.append(sides)
        links.append([(a, b) for a, x, y, _ in sides[0] for b, s, t, _ in sides[1] if x < t and s < y])
    count = Counter(pair for own in links for pair in set(own))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), (a, b), own in zip(rows, spans, links):
        cuts = sorted({t[2] for t in a} & {t[2] for t in b})
        at, groups = 0, []
        for cut in cuts:
            groups.append("|".join(",".join(str(t[0]) for t in side if at < t[2] <= cut) for side in (a, b)))
            at = cut
        out.append((i, len(a), len(b), len(groups), len(own), sum(count[p] for p in own), sum(count[p] == best[p[0]] for p in own), ";".join(groups)))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(4)
    words = ["alpha", "the", "of", "naïve", "Привет", "мир,", "日本語", "x" * 9, "1234567", "don't", "it's", "__init__", "<|endoftext|>", "</s>", "é", "🙂", "--", ");"]
    gaps = [" ", " ", " ", " ", "\n", "  ", "\n\n", " \n ", "\t", "\r\n", " ", "  ", "  ", "　\n", "\x1c ", "\x85 ", "\x0b", "—", "\x00 ", "… "]
    made = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    odd = [None, "", " ", "\n", "  \n", " x", "x ", "x  ", "x\n\n", "\nx", "a▁b", "▁", "word ▁ word", "﻿bom", "a  b", "a​ b", "q" * 3000, "日" * 500, "\x00", "\x01 \x02 x"]
    odd += ["the same text"] * 5 + ["junk " + "".join(chr(rng.randint(33, 0x2FFF)) for _ in range(50)) for _ in range(20)]
    return [(i if i % 9 else None, t) for i, t in enumerate(made + odd)] + [(3, "repeated id"), (3, "repeated id")]


@pytest.mark.parametrize("hot_bytes, block_pairs", [(T.HOT_BYTES, T.BLOCK_PAIRS), (4000, 100), (0, 50)])
def test_alignment(spark, encoders, hot_bytes, block_pairs):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "row", "seg", "seq", "rare", "groups", "n")}).repartition(3)
    got = T.align(df, T.files(BPE, PIECES), hot_bytes=hot_bytes, block_pairs=block_pairs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, encoders)


def test_no_rows(spark):
    assert T.align(spark.createDataFrame([], "doc_id long, text string"), T.files(BPE, PIECES)).collect() == []
    assert [tuple(r) for r in T.align(spark.createDataFrame([(1, None)], "doc_id long, text string"), T.files(BPE, PIECES)).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, sf_dir, encoders):
    from hashlib import sha256

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) < 3000").collect()]
    whole = {r.doc_id: r for r in op12_token_alignment(spark, sf_dir).collect()}
    for i, n_a, n_b, n_groups, n_links, _, _, groups in plain(rows, encoders):
        r = whole[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, n_links, sha256(groups.encode()).hexdigest() if n_a else "")
