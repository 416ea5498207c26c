"""Personal data, base kinds and terms that give them away (DataFrame functions only).

Base kinds (email, ip, card, phone) are matched by pattern and checked. Values that
occur in at least `MIN_CONTEXTS` different contexts are protected entities: for every
term of their documents the corpus tells how strongly it reveals the entity. With p(e) the
share of documents holding the entity and p(t), p(e, t) likewise for the term and for
both, the disclosure is PMI(e, t) / IC(e), with IC(e) = -log2 p(e): 1 if every document
with the term has the entity, 0 if they are independent. A term at or above
`DISCLOSURE` is a span of kind `term` wherever it occurs; one that reveals the entity
with certainty is removed from the sanitised text, others are generalised to their
shape, and base values to their kind.

Documents count whole, wherever in them the term and the entity stand. Contexts only
discount copies: a term counts for an entity only with `MIN_CONTEXTS` contexts of the
entity that differ, one from every document they share and any that the term stands
in, so copies of one document do not make its words revealing. A word that stands in
base values only is no term of theirs.

Patterns start at the beginning of a run and never give a run back, so they are
linear on long runs. Positions are running sums of the text between matches.

Defined results: a null text is empty and has no spans. Rows equal in doc_id and
text are searched once and each returned. Without protected entities there are no
terms. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.llm.common import keep, text_id

KINDS = ("email", "ip", "card", "phone", "term")
# Leftmost, non-overlapping matches of the contract's patterns, in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap sign without which a text has no match.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}
TERM = r"[\p{L}\p{N}]++"

CONTEXT = 60        # code points on each side of an entity that tell copies apart
PIECE = 128         # code points of a text that are cut out together
MIN_CONTEXTS = 5
DISCLOSURE = 0.95
DOC = ["doc_id", "t"]

_BYTE = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        x = digits.substr(n - i, F.lit(1)).cast("int")
        twice = x * 2 - F.when(x > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(x)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "ip", match.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$"))
            .when(kind == "card", F.when(n.between(12, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15))
            .otherwise(True))


def _cut(text: Column, kind: str, pattern: str) -> Column:
    """Matches with the length of the text between them."""
    between = F.split(text, pattern, -1)
    return F.struct(
        F.lit(kind).alias("kind"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.transform(between, F.length).alias("between"))


def _occurrences(texts: DataFrame, patterns: dict[str, str], signs: dict[str, str]) -> DataFrame:
    """DOC, kind, match, start and end of every match.

    texts: DOC and text, distinct.
    """
    cuts = [F.when(F.col("text").rlike(signs[k]), _cut(F.col("text"), k, p)) for k, p in patterns.items()]
    found = (texts.select(*DOC, F.explode(F.array_compact(F.array(*cuts))).alias("c"))
             .where(F.size("c.matches") > 0)
             .select(*DOC, "c.kind", F.posexplode(F.arrays_zip(
                 F.col("c.matches").alias("match"), F.col("c.between").alias("before"))))
             .where("col.match is not null")
             .select(*DOC, "kind", "pos", "col.match", F.col("col.before").alias("gap"),
                     F.length("col.match").alias("n"))
             .dropDuplicates([*DOC, "kind", "pos"]))    # repeated rows
    upto = Window.partitionBy(*DOC, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (found.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto))
            .select(*DOC, "kind", "match", (F.col("end") - F.col("n")).alias("start"), "end"))


def base_spans(texts: DataFrame) -> DataFrame:
    found = _occurrences(texts, PATTERNS, SIGNS)
    return found.where(_valid(F.col("kind"), F.col("match")))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """Code points from start to end of a text in pieces; linear in what is cut out."""
    first = F.floor(start / PIECE).cast("int")
    some = F.array_join(F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1), "")
    return F.when(end > start, some.substr((start - first * PIECE + 1).cast("int"), (end - start).cast("int"))).otherwise("")


def _holding(texts: DataFrame, spans: DataFrame, min_contexts: int) -> DataFrame:
    """DOC, seen (entity, left, right), outside and inside (terms out of and only in base values).

    Of documents with an entity that occurs often enough to be protected.
    """
    entity = F.concat_ws(":", "kind", F.lower("match"))
    spans = spans.select(*DOC, entity.alias("entity"), "start", "end")
    often = spans.groupBy(F.col("entity").alias("often")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_contexts)
    order = Window.partitionBy(*DOC).orderBy("start", "end", "entity").rowsBetween(Window.unboundedPreceding, -1)
    per = (spans.join(often, F.col("entity") == F.col("often"), "left")
           .withColumn("reach", F.coalesce(F.max("end").over(order), F.lit(0)))
           .groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_g"))
           .agg(F.sort_array(F.collect_list(F.struct("start", "end", "entity", "often", "reach"))).alias("spans"),
                F.max("end").alias("last")).where(F.exists("spans", lambda s: s["often"].isNotNull())))
    # Written first, so that its size is known before any text would be shuffled.
    per = keep(per, "entity-docs")
    rows = texts.join(per, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_g")))
    n = F.length("text").cast("long")

    def cut(c: Column) -> Column:
        seen = F.transform(F.filter("spans", lambda s: s["often"].isNotNull()), lambda s: F.struct(
            s["entity"].alias("entity"),
            _between(c, F.greatest(s["start"] - CONTEXT, F.lit(0)), s["start"]).alias("left"),
            _between(c, s["end"], F.least(s["end"] + CONTEXT, n)).alias("right")))
        rest = F.concat(F.transform("spans", lambda s: _between(c, s["reach"], s["start"])),
                        F.array(_between(c, F.col("last"), n)))
        return F.struct(seen.alias("seen"), _terms(F.array_join(rest, " ")).alias("outside"))
    # A lambda over one array, so that a text is put in pieces once.
    pieces = F.regexp_extract_all("text", F.lit(rf"[\s\S]{{1,{PIECE}}}+"), F.lit(0))
    rows = rows.select(*DOC, _terms(F.col("text")).alias("every"), F.explode(F.transform(F.array(pieces), cut)).alias("x"))
    return (rows.select(*DOC, "x.seen", "x.outside", F.array_except("every", "x.outside").alias("inside"))
            .dropDuplicates(DOC))    # repeated rows


def disclosing_terms(texts: DataFrame, spans: DataFrame, min_contexts: int = MIN_CONTEXTS,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """term and its highest disclosure, for terms at or above the threshold."""
    held = keep(_holding(texts, spans, min_contexts), "held")
    seen = held.select(*DOC, F.explode("seen").alias("s")).select(
        *DOC, "s.*", F.xxhash64("s.left", "s.right").alias("context"))
    protected = (seen.groupBy("entity", "context").agg(F.lit(1).alias("one"))
                 .groupBy("entity").agg(F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= min_contexts))
    first = seen.groupBy("entity", *DOC).agg(F.min("context").alias("context"))
    n_docs = texts.count()
    # A shown entity in every document carries no information to disclose.
    sizes = keep(first.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") < n_docs)
                 .join(protected.select("entity"), "entity"), "entities")
    if sizes.isEmpty():
        return seen.select(F.col("entity").alias("term"), F.lit(1.0).alias("disclosure")).limit(0)
    # Both at most n_entity documents, so a term in more than this stays below the threshold.
    most = F.pow("n_entity", F.lit(disclosure)) * F.pow(F.lit(float(n_docs)), F.lit(1 - disclosure)) * (1 + 1e-9)
    holders = keep(first.join(sizes.withColumn("most", most), "entity")
                   .select(F.col("doc_id").alias("_d"), F.col("t").alias("_g"), "entity", "context", "n_entity", "most"), "holders")
    # The cut ends of a context may be parts of words.
    words = F.concat_ws(" ", F.regexp_replace("left", r"^[\p{L}\p{N}]+", ""), F.regexp_replace("right", r"[\p{L}\p{N}]+$", ""))
    near = keep(seen.join(sizes.select("entity"), "entity", "left_semi")
                .select("entity", F.explode(_terms(words)).alias("term"), "context").distinct(), "near-terms")
    # A term in fewer documents than contexts are needed must stand near.
    df = (texts.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
          .where(F.col("n_term") <= sizes.agg(F.max(most)).first()[0])
          .join(near.select("term", F.lit(1).alias("is_near")).distinct(), "term", "left")
          .where((F.col("n_term") >= min_contexts) | F.col("is_near").isNotNull()).select("term", "n_term"))
    mark = lambda c, out: F.transform(c, lambda x: F.struct(x.alias("term"), F.lit(out).alias("outside")))
    wide = (held.select(*DOC, F.explode(F.concat(mark("outside", True), mark("inside", False))).alias("x"))
            .select(*DOC, "x.*").join(df, "term")
            .join(holders, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_g")) & (F.col("n_term") <= F.col("most")))
            .select("entity", "term", "context", "outside", F.lit(1).alias("n"), F.lit(False).alias("near"), "n_entity", "n_term"))
    none = F.lit(None).cast("long")
    close = near.select("entity", "term", "context", F.lit(False).alias("outside"), F.lit(0).alias("n"), F.lit(True).alias("near"),
                        none.alias("n_entity"), none.alias("n_term"))
    both = (wide.unionByName(close).groupBy("entity", "term", "context")
            .agg(F.sum("n").alias("n"), F.max("outside").alias("outside"), F.max("near").alias("near"),
                 F.max("n_entity").alias("n_entity"), F.max("n_term").alias("n_term"))
            .groupBy("entity", "term")
            .agg(F.sum("n").alias("n_both"), F.max("outside").alias("outside"), F.count_if(F.col("outside") | F.col("near")).alias("contexts"),
                 F.max("n_entity").alias("n_entity"), F.max("n_term").alias("n_term"))
            .where(F.col("outside") & (F.col("contexts") >= min_contexts)))
    information = -F.log2(F.col("n_entity") / n_docs)
    pmi = F.log2(F.col("n_both") * n_docs / (F.col("n_entity") * F.col("n_term")))
    return (both.where(pmi >= disclosure * information)
            .groupBy("term").agg(F.max(pmi / information).alias("disclosure")))


def all_spans(docs: DataFrame, min_contexts: int = MIN_CONTEXTS, disclosure: float = DISCLOSURE) -> DataFrame:
    """DOC, kind, start, end, match, disclosure of every span; docs: doc_id, text."""
    texts = docs.select("doc_id", text_id().alias("t"), F.coalesce("text", F.lit("")).alias("text"))
    base = keep(base_spans(texts).distinct(), "base-spans")
    terms = keep(disclosing_terms(texts, base, min_contexts, disclosure), "terms")
    spans = base.select(*DOC, "kind", "start", "end", "match", F.lit(None).cast("double").alias("disclosure"))
    if terms.isEmpty():
        return spans
    # Written first, so that its size is known before any text would be shuffled.
    holding = keep(texts.select(*DOC, F.explode(_terms(F.col("text"))).alias("term"))
                   .join(terms, "term", "left_semi").select(*DOC).distinct(), "holding")
    inside = texts.alias("x").join(holding.alias("y"), F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
                                   & (F.col("x.t") == F.col("y.t")), "left_semi")
    found = (_occurrences(inside, {"term": TERM}, {"term": "."}).withColumn("term", F.lower("match"))
             .join(terms, "term").select(*DOC, "kind", "start", "end", "match", "disclosure").distinct())
    return spans.unionByName(found)


def _joined(spans: Column) -> Column:
    order = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"),
        F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("shown")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: s["shown"]), ",")


def _attached(docs: DataFrame, spans: DataFrame, agg: list[Column]) -> DataFrame:
    per = spans.groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_g")).agg(*agg)
    return docs.join(per, F.col("_i").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_g")), "left")


def pii_digest(docs: DataFrame, **settings) -> DataFrame:
    spans = all_spans(docs.select("doc_id", "text"), **settings)
    rows = docs.select(F.col("doc_id").alias("_i"), text_id().alias("_t"))
    one = F.struct("kind", "start", "end")
    out = _attached(rows, spans, [F.collect_set(one).alias("spans")])
    every = F.coalesce("spans", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))
    base = F.filter(every, lambda s: s["kind"] != "term")
    def number(kind: str) -> Column:
        return F.size(F.filter(every, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    count = [number(k) for k in KINDS]
    return out.select(F.col("_i").alias("doc_id"), *count[:4], F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"),
                      _joined(every).alias("spans"), count[4])


def sanitise(docs: DataFrame, **settings) -> DataFrame:
    """docs with base values and disclosing terms replaced in text.

    Where spans overlap, the one that starts first (then the longer one) is replaced.
    """
    shown = (F.when(F.col("kind") != "term", F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
             .when(F.col("disclosure") >= 1 - 1e-9, "[REMOVED]")
             .when(F.col("match").rlike("[0-9]"), "[NUMBER]").otherwise("[WORD]"))
    spans = all_spans(docs.select("doc_id", "text"), **settings).withColumn("shown", shown)
    before = Window.partitionBy(*DOC).orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0))).where("start >= reach")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_i"),
                       text_id().alias("_t"), F.coalesce("text", F.lit("")).alias("_text"))
    out = _attached(rows, spans, [F.array_sort(F.collect_set(F.struct("start", "end", "shown", "reach"))).alias("_s")])
    text = F.col("_text")
    parts = F.transform("_s", lambda s: F.concat(text.substr(s["reach"].cast("int") + 1, (s["start"] - s["reach"]).cast("int")), s["shown"]))
    last = F.element_at("_s", -1)["end"].cast("int")
    new = F.when(F.col("_s").isNull(), F.col("_row.text")).otherwise(
        F.concat(F.array_join(parts, ""), text.substr(last + 1, F.length(text))))
    return out.select(*[new.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
