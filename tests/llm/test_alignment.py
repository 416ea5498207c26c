"""Alignment against a token-by-token version on fresh tokenizers."""

import collections
import hashlib
import random

import numpy as np
import pytest

from cohortlens.llm import alignment

SCHEMA = "doc_id long, text string, row int, links string"


def make_rows():
    r = random.Random(11)
    words = ["the", "walking", "naïve", "Étion", "antidisestablishmentarianism", "x1", "2024", "<|endoftext|>", "<s>", "</s>",
             "<0x41>", "日本語", "\t", "\n", "  ", "①", "🙂", "Ω", "re-do", "it's"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 60)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " "), (63, "▁under ▁the bar"), (64, "same text here"), (65, "same text here"),
             (65, "same text here"), (None, "no id"), (66, "long word " * 12000), (67, "a\x00b"), (68, "é ﬁ   x")]
    return rows


ROWS = make_rows()


def tokens(text):
    import public_tokenizers as p
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(tokens, "a"):
        tokens.a = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
        tokens.a.encode_special_tokens = True
        tokens.b = sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in shown]
        tokens.byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(rest)}
    if not text:
        return [], []
    a = [(i, bytes(tokens.byte[c] for c in tokens.a.id_to_token(i))) for i in tokens.a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in tokens.b.encode(text):
        piece = tokens.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if tokens.b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def by_definition():
    docs, counts = [], collections.Counter()
    for doc, text in ROWS:
        sides = tokens(text)
        ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in sides]
        shared = set(ends[0]) & set(ends[1])
        links = [(sides[0][ends[0].index(e)][0], sides[1][ends[1].index(e)][0]) for e in sorted(shared)]
        counts.update(links)
        groups, start = [], [0, 0]
        for e in sorted(shared):
            stop = [x.index(e) + 1 for x in ends]
            groups.append("|".join(",".join(str(i) for i, _ in s[a:b]) for s, a, b in zip(sides, start, stop)))
            start = stop
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        docs.append((doc, len(sides[0]), len(sides[1]), len(shared), links, sha))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(((d, a, b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
                   for d, a, b, g, links, sha in docs), key=str)


@pytest.mark.parametrize("common", [alignment.COMMON, 40, 0])
def test_alignment_by_definition(spark, common):
    docs = spark.createDataFrame([(*x, 1, "k") for x in ROWS], SCHEMA).repartition(3)
    rows = alignment.aligned(docs, alignment.public_files(), common).collect()
    assert sorted([tuple(x) for x in rows], key=str) == by_definition()


def test_no_documents(spark):
    assert alignment.alignment_digest(spark.createDataFrame([], SCHEMA)).count() == 0
