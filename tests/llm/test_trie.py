"""The prefix trie against its definition, in one shard and in many."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortlens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, words string"


def make_rows():
    r = random.Random(3)
    rows = []
    for c in range(-25, 160):
        for t in range(r.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["a b", "c", "", None, "d  e\tf"])))
    # Long conversations, two equal and one that leaves them; ties, equal rows, nulls.
    for t in range(200):
        rows += [(200, t, "user", f"long one {t}"), (201, t, "user", f"long one {t}"),
                 (203, t if t != 150 else 7, "user", f"long one {t % 40}")]
    rows += [(None, 1, "user", "x"), (5, None, "user", "nul"), (5, None, "user", "nul"), (300, 0, "user", "w " * 50000)]
    return rows


ROWS = make_rows()


def by_definition(rows):
    conv = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            text = text or ""
            conv[c].append(((t is not None, t or 0), role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in conv.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        built[c] = own.get(head, [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words
    out = {}
    for p, m in members.items():
        end = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out[min(m), len(p)] = (min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                               hashlib.sha256(end.encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment, shard", [(trie.SEGMENT, trie.SHARD), (3, 20)])
def test_trie_by_definition(spark, segment, shard):
    df = spark.createDataFrame([(*x, 1, "w") for x in ROWS], SCHEMA).repartition(5)
    rows = trie.trie_digest(df, segment, shard).collect()
    got = {(x.conv_id, x.depth): (x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves, x.saved_tokens, x.ends_sha256) for x in rows}
    assert len(rows) == len(got)
    assert got == by_definition(ROWS)


def test_no_conversations(spark):
    assert trie.trie_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_double_array_holds_its_sequences_only():
    r = random.Random(1)
    seqs = sorted({tuple(r.randrange(30) for _ in range(r.randrange(1, 6))) for _ in range(400)})
    flat = sorted((i, k, t) for k, s in enumerate(seqs) for i, t in enumerate(s))
    level, seq, ids = (np.array(x) for x in zip(*flat))
    root = np.array([s[0] % 3 for s in seqs])
    array = trie.DoubleArray(ids, level, seq, root, 30)
    states = {}
    for k, s in enumerate(seqs):
        at = np.array([root[k]])
        for d, t in enumerate(s):
            at = array.step(at, np.array([t]))
            assert states.setdefault(int(at[0]), (root[k], s[:d + 1])) == (root[k], s[:d + 1])
    assert len(states) == len({(root[k], s[:d]) for k, s in enumerate(seqs) for d in range(1, len(s) + 1)})
    absent = next(t for t in range(30) if (t,) not in {s[:1] for s, k in zip(seqs, root) if k == 0})
    with pytest.raises(ValueError):
        array.step(np.array([0]), np.array([absent]))
