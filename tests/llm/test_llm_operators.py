"""Operators against brute force, on a small table with every awkward row."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import chat, embeddings, line_dedup, minhash, mixing, packing, pii, quality, sharding, urls
from cohortlens.llm.components import components, union_find

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, rank int"


def make_rows():
    r = random.Random(5)
    words = ["alpha", "Beta", "gamma", "dÉlta", "eps", "zeta", "Eta", "theta", "iota", "kappa", "x1", "y-2"]
    rows = [(None, "no id here but a shared boilerplate line", None, None), (0, None, "en", "b"), (1, "", "en", "b"),
            (2, " \n\t ", "en", None), (3, "One", "en", "a"), (4, "word " * 9000, "en", "a"), (5, "x" * 30000, "en", "a")]
    base = [" ".join(r.choice(words) + str(r.randrange(60)) for _ in range(90)) for _ in range(6)]
    for i in range(10, 70):
        w = base[i % 6].split(" ")
        for _ in range(r.choice([0, 0, 1, 2, 4, 9])):
            w[r.randrange(len(w))] = f"new{r.randrange(999)}"
        text = " ".join(w[:45]) + "\n  A Shared Boilerplate LINE éÉ  \n" + " ".join(w[45:]) + "\n\nshort"
        rows.append((i, text, "en", r.choice(["a", "b", "c", None])))
    rows += [rows[20], (80, rows[21][1], "de", "zz")]   # a repeated row, and an exact copy
    return [(d, t, lang, s, len(t or ""), 7, "k", 1) for d, t, lang, s in rows]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


def collected(df):
    return [r.asDict() for r in df.collect()]


def test_lines(docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(list)
    for row in ROWS:
        for k in {key(x) for x in (row[1] or "").split("\n")}:
            holders[k].append(row[0])
    expected = collections.Counter()
    for d, t, *_ in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3
                or d == max(h for h in holders[key(x)] if h is not None)]
        expected[d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    got = collected(line_dedup.line_dedup_digest(docs, batches=5, fanout=2))
    assert collections.Counter(tuple(r.values()) for r in got) == expected
    assert sum(n for *_, n, _ in expected) > 10
    assert line_dedup.dedup_lines(docs).columns[:len(docs.columns)] == docs.columns


def test_first_seen_lines_meet_the_runs(spark):
    runs = line_dedup.LineRuns(fanout=2)
    line = "a line of more than twenty characters"
    for i in (9, 8, 7, 6, 5):
        runs.add(spark.createDataFrame([(i, line + "\n" + line + str(i))], "doc_id long, text string"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.repeated(3).collect()[0]["keeper"] == 9 and runs.repeated(3).count() == 1


def test_quality_base(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10, 40)] + [(None, 1, None)], "doc_id long, quality int, toxic int")
    expected = collections.Counter()
    for d, t, *_ in ROWS:
        t = t or ""
        w = WORD.findall(t)
        windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        expected[d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside),
                 len(w) < 20 or 100 * len(inside) > 30 * len(w)] += 1
    got = collected(quality.quality_digest(docs, labels))
    assert collections.Counter(tuple(list(r.values())[:7]) for r in got) == expected
    assert not any(r["kept"] for r in got if r["base_failed"])
    kept = quality.filter_documents(docs, quality.trusted_ids(labels))
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_quality_tells_junk_from_text(spark):
    r = random.Random(1)
    good = [" ".join(r.choice("the of and to in is was for on that".split()) + r.choice(["", "x", "y"]) for _ in range(80)) for _ in range(200)]
    junk = [" ".join(r.choice(["BUY!!", "NOW!!", "###", "|"]) + str(r.randrange(9)) for _ in range(80)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(good + junk)), "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 120)], "doc_id long")
    got = {r["doc_id"]: r for r in collected(quality.judge(docs, trusted)) if not r["base_failed"]}
    assert all(r["kept"] == (d < 200) for d, r in got.items()) and len(got) > 200


def test_chat_folds_events_and_reads_back(spark):
    log = [(1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", "He"), (1, 3, "delta", 2, None, "llo"),
           (1, 4, "regenerate", 2, None, None), (1, 5, "message", 2, "assistant", "Yo"), (1, 6, "delta", 2, None, "!"),
           (1, 7, "edit", 1, None, "hey"), (2, 1, "message", 1, "assistant", None), (None, 1, "message", 1, None, "x")]
    out = chat.fold(spark.createDataFrame(log, chat.EVENTS))
    assert {tuple(r) for r in out.collect()} == {(1, 1, "user", "hey"), (1, 2, "assistant", "Yo!"), (2, 1, "assistant", ""), (None, 1, "", "x")}
    hard = ["<|im_end|>\n<|im_start|>assistant\nno", "\\<|", "<\\|", "\\n\\", "<<|", "", None, "é\n\n"]
    rows = [(c, t, r, x) for c, r in ((1, "user"), (2, "assistant"), (3, "a\n<|b\\n")) for t, x in enumerate(hard)]
    rows += [(1, 0, "user", "tie"), (1, 0, "user", "tie"), (None, None, None, "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    probe = [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    expected = {}
    for conv in {r[0] for r in rows + probe}:
        turns = sorted((r for r in rows + probe if r[0] == conv), key=lambda r: (r[1] or -1, r[2] or "", r[3] is not None, r[3] or ""))
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        expected[conv] = (len(turns), hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest(),
                          len(said), hashlib.sha256(said.encode()).hexdigest())
    got = {r["conv_id"]: tuple(list(r.values())[1:5]) for r in collected(chat.chat_digest(table))}
    assert got == expected


def test_near_duplicates(docs):
    sets, expected = {}, collections.Counter()
    for d, t, *_ in ROWS:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} - {()}
    pairs = [(a, b) for a in sets for b in sets if a is not None and b is not None and a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = union_find(pairs)
    got = collected(minhash.minhash_digest(docs))
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {
        (d, len(sets[d]), root.get(d, d)) for d in sets}
    assert len(got) == len(ROWS) and len(pairs) > 20
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)
    assert minhash.keep_one(docs, shingle=4).columns == docs.columns


def test_a_large_group_of_near_copies(spark):
    r = random.Random(3)
    base, rows, k = [f"w{i}" for i in range(120)], [], 4
    for i in range(300):
        w = list(base)
        for _ in range(r.randrange(1, 8)):
            w[r.randrange(120)] = f"n{r.randrange(40)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[i:i + k]) for i in range(117)} for _, t in rows]
    root = union_find([(a, b) for a in range(300) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = minhash.minhash_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: root.get(i, i) for i in range(300)}
    assert 1 < len({r["component_id"] for r in got}) < 300


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(500, 501), (7, 7)]
    random.Random(2).shuffle(chain)
    got = dict(components(spark.createDataFrame(chain, "a long, b long").repartition(7)).collect())
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_personal_data(spark):
    texts = [None, "", "é a@b.c_x@d.e-f.gg, 1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.255", "4111 1111-1111 1111 4111111111111112 +1 (555) 010-9999. +12((",
             "a.b@c d@e. f@g.h.", "++1 23456789 x" * 50, "a" * 20000 + "@" + "b" * 20000, "1" * 20000, "1 " * 9000, "+1" + " " * 9000]
    r = random.Random(4)
    texts += ["".join(r.choice("a@.1 2-+(9é\n") for _ in range(60)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x@y.zz"), (3, texts[3])], "doc_id long, text string")
    got = collected(pii.pii_digest(docs))
    assert len(got) == len(texts) + 2
    for row in got:
        spans = base_spans("x@y.zz" if row["doc_id"] is None else texts[row["doc_id"]])
        assert row["spans"].split(",") == (spans or [""])
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in spans) for k in PATTERNS]


def test_terms_that_disclose(spark):
    rows = [(i, f"filler{i} Projekt Zephyrine reach ann@corp.example now item{i}") for i in range(8)]
    rows += [(i, f"common reach now words number{i}") for i in range(8, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in collected(pii.pii_digest(docs))}
    assert got[0]["n_term"] == 2 and got[9]["n_term"] == 0 and got[0]["n_email"] == 1
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == "filler0 [REMOVED] [REMOVED] reach [EMAIL] now item0" and clean[9] == rows[9][1]


def test_terms_disclose_from_anywhere_in_a_document(spark):
    gap = "common words between them " * 8
    rows = [(i, f"Dear Zephyrine {gap} row{i} ann@corp.example, bob{i}@x.yy end{i}") for i in range(6)]
    rows += [(20 + i, f"Half {'Quillon' if i % 2 else ''} {gap} {'' if i % 2 else 'Quillon '}his{i} 10.1.2.3 end{i}") for i in range(12)]
    rows += [(40 + i, f"{gap} only{i}") for i in range(60)] + [(200 + i, f"{gap} Copied copy +1 (555) 010-9999 same") for i in range(7)]
    got = {r["doc_id"]: r for r in collected(pii.pii_digest(spark.createDataFrame(rows, "doc_id long, text string")))}
    words = {d: sorted({x[int(p[1]):int(p[2])] for p in (s.split(":") for s in got[d]["spans"].split(",") if s) if p[0] == "term"})
             for d, x in rows}
    assert all(words[d] == ["Dear", "Zephyrine"] for d in range(6))
    assert all(words[20 + i] == ["Half", "Quillon"] for i in range(12))
    assert not any(words[d] for d, _ in rows if d >= 40)


def test_short_names_disclose(spark):
    rows = [(i, f"note{i} to Kim and 李 in the house x mail kim.l@corp.example item{i}") for i in range(8)]
    rows += [(i, f"words to and in the house x number{i}") for i in range(8, 60)]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[0] == "note0 to [REMOVED] and [REMOVED] in the house x [REMOVED] [EMAIL] item0" and clean[9] == rows[9][1]


def test_shards(docs, spark):
    got = collected(sharding.sharding_digest(docs))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    same = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    sizes = collections.Counter()
    for r in collected(sharding.sharding_digest(same)):
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 0.005 * sum(sizes.values()) / 8 + 10


def test_urls(spark):
    pages = [(1, None), (2, "no scheme"), (3, "HTTP://A.Net/x"), (4, "x://www.example.net/en/9?q#f"), (5, "x://a.example.com/de/1"),
             (6, "x://example.com"), (7, "x://b.org/fr/2"), (8, "x://notnet/"), (9, "x://net"), (9, "x://net/"), (None, "x://h/p/1")]
    pages += [(100 + i, f"http://h.example.com/{'spam' if i % 2 else 'news'}/{i}.html") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, i % 2 == 0) for i in range(60)] + [(None, True), (1, None)], "page_id long, good boolean")
    got = collected(urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), labels))
    assert len(got) == len(pages)
    shown = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in got if r["page_id"] and r["page_id"] < 9}
    assert shown == {1: ("", "", None), 2: ("", "", None), 3: ("a.net", "/x", "net/"), 4: ("www.example.net", "/en/9", "example.net/en/"),
                     5: ("a.example.com", "/de/1", "example.com/de/"), 6: ("example.com", "", None), 7: ("b.org", "/fr/2", "org/fr/"), 8: ("notnet", "/", None)}
    assert sorted(r["rule"] or "" for r in got if r["page_id"] == 9) == ["", "net/"]
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got if (r["page_id"] or 0) >= 100)
    assert {r["template"] for r in got if (r["page_id"] or 0) >= 100} == {"/spam/*.html", "/news/*.html"}


def test_urls_judge_every_branch_by_its_labels(spark):
    bad = {f"dir{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}": i % 4 == 0 for i in range(40)} | {"casino24": True, "news24": False, "quiet9": None}
    pages = [(i, f"http://wide.example/{name}/{i}-{name}.html") for i, name in enumerate(n for n in bad for _ in range(30))]
    labels = [(i, not bad[u.split("/")[3]]) for i, u in pages if bad[u.split("/")[3]] is not None]
    got = collected(urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                                    spark.createDataFrame(labels, "page_id long, good boolean")))
    verdicts = collections.defaultdict(set)
    for r in got:
        verdicts[r["path"].split("/")[1]].add(r["verdict"])
    assert verdicts == {name: {"block" if b else "allow"} for name, b in bad.items()}
    assert {r["template"] for r in got if "casino24" in r["path"]} == {"/casino24/*.html"}


def test_embeddings(spark):
    g = np.random.Generator(np.random.PCG64(1))
    rows, n = [], 0
    for label in (0, 1, None):
        centres = g.normal(size=(12, 16))
        for _ in range(220):
            v = centres[g.integers(12)] + g.normal(size=16) * g.choice([0, 0.05, 0.15, 0.3])
            rows.append((n, [float(x) for x in v.astype(np.float32) * g.choice([1, 3])], label))
            n += 1
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [rows[0]]
    expected, links = {r[0]: 0 for r in rows}, []
    usable = [r for r in rows[:-1] if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    for i, a in enumerate(usable):
        for b in usable[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98:
                links.append((a[0], b[0]))
                expected[a[0]] += 1
                expected[b[0]] += 1
    root = union_find(links)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embeddings.near_vectors(table, block=32, leading=4).collect()
    assert {tuple(r) for r in got} == {(i, k, root.get(i, i), root.get(i, i) == i) for i, k in expected.items()}
    assert len(links) > 200


def test_mix(docs):
    got = collected(mixing.mixing_digest(docs))
    sizes = collections.Counter()
    for _, t, _, s, *_ in ROWS:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(s for s in sizes if s is not None) + [None]
    weight, fixed, total = {s: i % 3 + 1 for i, s in enumerate(names)}, {}, sum(sizes.values())
    while True:
        free = sum(w for s, w in weight.items() if s not in fixed)
        each = (total - sum(fixed.values())) / free
        over = {s: 3 * sizes[s] for s in names if s not in fixed and each * weight[s] > 3 * sizes[s]}
        if not over:
            break
        fixed.update(over)
    taken = collections.Counter()
    source = {d: s for d, _, _, s, *_ in ROWS}
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[source[r["doc_id"]]]
        taken[source[r["doc_id"]]] += r["taken"]
        assert r["target"] == pytest.approx(fixed.get(source[r["doc_id"]], each * weight[source[r["doc_id"]]]))
    for s in names:
        assert abs(taken[s] - fixed.get(s, each * weight[s])) <= 0.01 * total / 4 + 4
    assert collections.Counter(map(str, got)) == collections.Counter(map(str, collected(mixing.mixing_digest(docs.repartition(5)))))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(WORD.findall(r["text"])) for r in mixed.collect())
    assert abs(words - sum(taken.values())) <= 5


def test_mix_gives_small_sources_their_target(spark):
    rows = [(i, "big " * 500, f"big{i % 3}") for i in range(60)] + [(100 + i, "one two three four", f"small{i:02}") for i in range(40)]
    rows += [(200, None, "none"), (201, "seven words are in this null source", None)]
    got = collected(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=64, min_slots=1))
    source, taken, target = {d: s for d, _, s in rows}, collections.Counter(), {}
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert {s: taken[s] for s in target} == {s: int(np.ceil(t)) for s, t in target.items()}
    assert all(0 < taken[f"small{i:02}"] < 64 for i in range(40)) and taken["none"] == 0 and taken[None] > 0


def test_schedule_mixes_every_stretch(spark):
    wanted = spark.createDataFrame([(0, 50000.0), (1, 7.5), (2, 150000.0), (3, 0.0)], "idx long, target double")
    slots = sorted(mixing.schedule(wanted, 10).collect())
    assert [r["slot"] for r in slots] == list(range(20001))
    for idx, words in ((0, 50000), (1, 8), (2, 150000)):
        own = [r for r in slots if r["idx"] == idx]
        assert [r["rank"] for r in own] == list(range(len(own))) and sum(r["words"] for r in own) == words
    for i in range(0, 20000, 400):
        assert abs(sum(r["idx"] == 0 for r in slots[i:i + 400]) - 100) <= 3


def test_pack(docs):
    encoder = packing.Encoder.of(*packing.public_tokenizer())
    got = collected(packing.packing_digest(docs))
    ids = {d: encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t, *_ in ROWS}
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 2048
    assert sum(r["length"] for r in got) == sum(len(ids[d]) for d, *_ in ROWS)
    rows = collections.defaultdict(list)
    for r in got:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in rows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(rows) <= -(-sum(len(ids[d]) for d, *_ in ROWS) // 2048) + 1


def test_encoders_agree():
    encoder, r = packing.Encoder.of(*packing.public_tokenizer()), random.Random(1)
    letters = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2020), 0x4E2D, 0x1F600]]
    for _ in range(1500):
        text = "".join(r.choice(letters if r.random() < 0.5 else " \n\t\r\x0b\x85\xa0\x1cab'sS1²ª.,") for _ in range(r.randrange(60)))
        assert encoder.encode(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_added_tokens_are_encoded_as_the_tokenizer_is_loaded(spark):
    from tokenizers import Tokenizer

    fresh, text = Tokenizer.from_file(packing.public_tokenizer()[0]), "a <|endoftext|> b"
    ids = np.array(fresh.encode(text, add_special_tokens=False).ids, "<u4")
    assert 50256 in ids
    assert packing.Encoder.of(*packing.public_tokenizer()).encode(text) == ids.tobytes()
    plain = np.frombuffer(packing.Encoder.of(*packing.public_tokenizer(), plain=True).encode(text), "<u4")
    assert 50256 not in plain and fresh.decode(plain.tolist(), skip_special_tokens=False) == text
    row = packing.packing_digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["length"], row["ids_crc32"]) == (len(ids) + 1, zlib.crc32(ids.tobytes() + bytes(4)))


def test_plan_places_every_rank_once():
    r = random.Random(6)
    counts = {r.randrange(1, 2049): r.randrange(1, 500) for _ in range(300)}
    ranks, space = collections.defaultdict(list), collections.Counter()
    for length, rank, n, first, offset in packing.plan(counts):
        ranks[length] += range(rank, rank + n)
        for s in range(first, first + n):
            assert space[s] == offset
            space[s] += length
    assert all(sorted(ranks[k]) == list(range(n)) for k, n in counts.items()) and max(space.values()) <= 2048
    assert len(space) <= 1.02 * sum(k * n for k, n in counts.items()) / 2048 + 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert line_dedup.line_dedup_digest(docs).count() == 0
    assert quality.quality_digest(docs, labels).count() == 0
    assert minhash.minhash_digest(docs).count() == 0
    assert pii.pii_digest(docs).count() == 0
    assert sharding.sharding_digest(docs).count() == 0
    assert mixing.mixing_digest(docs).count() == 0
    assert packing.packing_digest(docs).count() == 0
    assert chat.chat_digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 1
    assert urls.urls_digest(spark.createDataFrame([], "page_id long, url string"), labels).count() == 0
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_two_texts_under_one_id_are_judged_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(3, a, 1), (5, a, 1), (5, b, 1), (7, b, 1), (9, "alone at last", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _doc int")
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(3, a), (5, b), (9, "alone at last")]


def test_texts_around_one_passage_are_joined_on_rare_elements(spark):
    r = random.Random(8)
    passage, rows = [f"p{i}" for i in range(45)], []
    for i in range(60):  # own words around the passage; every third text twice more, edited
        own = [f"o{i}_{j}" for j in range(r.randrange(5, 70))]
        rows.append((len(rows), " ".join(own + passage)))
        for _ in range(2 if i % 3 == 0 else 0):
            w = own + passage
            at = r.randrange(len(w) - 5)
            del w[at:at + r.randrange(1, 5)]
            w[r.randrange(len(w))] = f"e{len(rows)}"
            rows.append((len(rows), " ".join(w)))
    sets = [{tuple(t.split()[i:i + 4]) for i in range(len(t.split()) - 3)} for _, t in rows]
    linked = {(b, a) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(linked) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = docs.mapInArrow(minhash._packed_sets(4), "set_a long, set_b long, shingles binary")
    named = spark.createDataFrame(list(enumerate(bytes(p["shingles"]) for p in packed.collect())), "doc long, shingles binary")
    rarity = spark.sparkContext.broadcast(minhash._rarity(named))
    prefixes = named.mapInArrow(minhash._prefixes(80, rarity), "doc long, n long, pos long, e long")
    shared = minhash._shared_elements(prefixes, None)
    side = (F.col("comp_y") == F.col("big")) | (F.col("doc_x") < F.col("doc_y"))
    pairs = {tuple(p) for p in minhash._prefix_pairs(shared.where("comp <> big"), shared, 80, side).collect()}
    assert linked <= pairs and len(pairs) < 10 * len(linked)
    root = union_find(linked)
    got = minhash.minhash_digest(docs).collect()
    assert {x["doc_id"]: x["component_id"] for x in got} == {i: root.get(i, i) for i in range(len(rows))}
