"""Readable labels for coded demographic combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.functions.columns import combination_items, lookup
from cohortlens.functions.staging import small_side

# Labels published for the codes of one known data set. Channel
# codes 3 and 6 stand for product names there; a site adds its own labels
# through the `labels` argument.
KNOWN_LABELS = {
    "marital_status": {
        "0": "divorced", "1": "married", "2": "others", "3": "separated", "4": "single",
        "5": "widowed",
    },
    "dw_channel_key": {
        "0": "android", "1": "FSA", "2": "IOS", "4": "TSA", "5": "web",
    },
    "gender": {"0": "female", "1": "male"},
    "employment_status": {
        "0": "employed", "1": "others", "2": "self_employed", "3": "unemployed",
    },
    "purpose": {
        "0": "auto/transportation", "1": "consumer_goods", "2": "education",
        "3": "electronics", "4": "emergency_funds", "5": "events", "6": "healthcare",
        "7": "housing", "8": "personal", "9": "retail/home_goods", "10": "transportation",
        "11": "travel_&_hospitality", "12": "uncategorized", "13": "utilities",
    },
}

# Text in front of a code that has no label, and of plain values.
PREFIXES = {
    "income_bracket": "income: ",
    "age_category": "age: ",
    "marital_status": "marital_status: ",
    "dw_channel_key": "channel: ",
    "gender": "gender: ",
    "employment_status": "employment: ",
    "purpose": "for_",
}


def _by_item(labels: dict[str, dict[str, str]]) -> dict[str, str]:
    return {f"{demo}={code}": label
            for demo, codes in labels.items() for code, label in codes.items()}


# SQL for the text of a part that has no label; `prefixes` is the PREFIXES map.
FALLBACK = ("concat(coalesce(try_element_at(prefixes, x.demo), concat(x.demo, ': ')), x.value)")


def decode_known(df: DataFrame, text: str = "combination", name: str = "decoded",
                 labels: dict[str, dict[str, str]] = KNOWN_LABELS) -> DataFrame:
    """Adds the combination with the given labels, parts joined by ', '."""
    label = (f"if(x.demo IS NULL, x.value, coalesce("
             f"try_element_at(labels, concat(x.demo, '=', x.value)), {FALLBACK}))")
    return (df.withColumns({"labels": lookup(_by_item(labels)), "prefixes": lookup(PREFIXES)})
            .withColumn(name, F.expr(f"array_join(transform({combination_items(text)}, "
                                     f"x -> {label}), ', ')"))
            .drop("labels", "prefixes"))


def decode_with_codes(profiles: DataFrame, codes: DataFrame) -> DataFrame:
    """Adds `text`: the combination with the labels this run really encoded."""
    parts = profiles.selectExpr("segment", "place",
                                f"posexplode({combination_items('combination')}) AS (at, x)")
    side = small_side(codes.selectExpr("feature", "cast(code AS string) AS code", "category"))
    label = (f"if(x.demo IS NULL, x.value, coalesce(lower(category), {FALLBACK}))")
    texts = (parts.join(side, F.expr("x.demo = feature AND x.value = code"), "left")
             .withColumn("prefixes", lookup(PREFIXES))
             .selectExpr("segment", "place", "at", f"{label} AS label")
             .groupBy("segment", "place")
             .agg(F.expr("array_join(transform(array_sort(collect_list(struct(at, label))), "
                         "p -> p.label), ', ') AS text")))
    return profiles.join(texts, ["segment", "place"], "left").na.fill("", ["text"])


# Fields looked for in combination texts.
LOOKED_FOR = ("marital_status", "dw_channel_key", "age_category", "income_bracket",
              "employment_status", "purpose", "gender", "state", "location")


def fields_present(profiles: DataFrame) -> DataFrame:
    """Which demographic fields occur in any combination text."""
    flags = ", ".join(
        f"named_struct('field', '{f}', 'present', "
        f"coalesce(bool_or(contains(combination, '{f}')), false))" for f in LOOKED_FOR)
    return profiles.agg(F.expr(f"array({flags}) AS flags")).selectExpr("inline(flags)")
