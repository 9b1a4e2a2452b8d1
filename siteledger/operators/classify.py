"""Junk-page classifier and crawl-status rules."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, text_list
from .rules import PARTS, Rule, default_rules

_SEPARATOR = "\x1f"
VALID_STATUS = 200
JUNK_BITRIX_STATUS = 228

# Status stored for each kind of fetch error. Other kinds (ssl,
# cookie, data, value, db) leave the stored status as it is.
ERROR_STATUS = {
    "connect": 404,
    "os": 404,
    "reset": 404,
    "payload": 400,
    "response": 400,
    "timeout": 408,
    "disconnect": 800,
    "unicode": 888,
}


def _regex(rule: Rule) -> str:
    """Words are lower-cased and bounded but, on purpose, not escaped."""
    return rf"\b{rule.pattern.lower()}\b" if rule.word else rule.pattern


def _literal_piece(rule: Rule) -> str:
    """Longest plain text a hit must contain; "" when there is none."""
    if not rule.word or re.search(r"[\[\](){}|?*+\\^$]", rule.pattern):
        return ""
    return max(rule.pattern.lower().split("."), key=len)


def _hits(text: Column, rules: Sequence[Rule]) -> Column:
    """Whether any rule of one category hits the lower-cased text.

    A plain byte search goes first, so most texts never meet the regex.
    """
    alternation = "|".join(f"(?:{_regex(r)})" for r in rules)
    matched = F.rlike(text, F.lit(f"(?U){alternation}"))
    pieces = [_literal_piece(r) for r in rules]
    if all(pieces):
        return F.exists(text_list(list(dict.fromkeys(pieces))), lambda p: F.contains(text, p)) & matched
    return matched


def _first_hit(categories: Sequence[tuple[str, int, list[Rule]]], low: dict[str, Column]) -> Column:
    """The first pattern that hits in the category found; looked up for junk pages only."""
    category = F.col("_category")
    patterns = text_list([_SEPARATOR.join(_regex(r) for r in members) for _, _, members in categories])
    part = F.get(text_list([str(PARTS.index(p)) for p, _, _ in categories]).cast("array<int>"), category)
    hits = let(
        F.get(F.array(*[low[p] for p in PARTS]), part),
        lambda text: F.filter(
            F.split(F.get(patterns, category), _SEPARATOR), lambda p: F.rlike(text, F.concat(F.lit("(?U)"), p))
        ),
    )
    return F.when(category.isNotNull(), F.get(hits, F.lit(0)))


def _categories(rules: Sequence[Rule]):
    """Runs of rules with one (part, status), in the order they are tried."""
    ordered = sorted(rules, key=lambda r: (PARTS.index(r.part), r.ord))
    for (part, status), run in groupby(ordered, key=lambda r: (r.part, r.status)):
        yield part, status, list(run)


def classify_pages(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    *,
    url: Column | str = "real_url",
    title: Column | str = "title",
    description: Column | str = "description",
    content: Column | str = "text",
) -> DataFrame:
    """Add ``junk_status`` and ``banword``: the first rule that hits, else NULL.

    NULL texts count as "". Pass ``F.lit("")`` for parts that are not there.
    """
    rules = default_rules() if rules is None else list(rules)
    parts = {"url": url, "title": title, "description": description, "content": content}
    lowered = {
        part: F.coalesce(F.lower(F.col(c) if isinstance(c, str) else c), F.lit("")).alias(f"_low_{part}")
        for part, c in parts.items()
    }
    low = {part: F.col(f"_low_{part}") for part in PARTS}
    categories = list(_categories(rules))
    hit, word = F.lit(None).cast("int"), F.lit(None).cast("string")
    if categories:
        for i, (part, _, members) in enumerate(categories):
            condition = _hits(low[part], members)
            hit = F.when(condition, F.lit(i)) if i == 0 else hit.when(condition, F.lit(i))
        word = _first_hit(categories, low)
    statuses = text_list([str(status) for _, status, _ in categories]).cast("array<int>") if categories else F.array().cast("array<int>")
    # Exploding a one-element array keeps the row as it is, but filters on the
    # outcome stay above it: moved below, they would read every text again.
    return (
        df.select("*", *lowered.values())
        .select("*", F.explode(F.array(hit)).alias("_category"))
        .select(
            *[F.col(f"`{c}`") for c in df.columns],
            F.get(statuses, F.col("_category")).alias("junk_status"),
            word.alias("banword"),
        )
    )


def page_status(df: DataFrame) -> DataFrame:
    """Add ``page_status``: 200 for a valid page, 228 for junk on Bitrix, else the rule."""
    return df.withColumn(
        "page_status",
        F.when(F.col("junk_status").isNull(), F.lit(VALID_STATUS))
        .when(F.col("cms") == F.lit("Bitrix"), F.lit(JUNK_BITRIX_STATUS))
        .otherwise(F.col("junk_status")),
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, junk) pages by ``page_status``.

    Both read the same input; pass a written table so that extraction runs once.
    """
    is_valid = F.col("page_status") == VALID_STATUS
    return df.where(is_valid), df.where(~is_valid)


def clean_domain_info(info: DataFrame, rules: Sequence[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Re-check stored url, title and description; returns (kept, deleted)."""
    checked = classify_pages(info, rules, url="real_domain", content=F.lit(""))
    hit = F.col("junk_status").isNotNull()
    return checked.where(~hit).drop("junk_status", "banword"), checked.where(hit)


def error_status(error_kind: Column) -> Column:
    """Status for a fetch error; NULL when the stored status must not change."""
    status = F.lit(None).cast("int")
    for i, (kind, code) in enumerate(ERROR_STATUS.items()):
        condition = error_kind == F.lit(kind)
        status = F.when(condition, F.lit(code)) if i == 0 else status.when(condition, F.lit(code))
    return status


def attempt_code(http_status: Column, error_kind: Column) -> Column:
    """Status an attempt without a page asks for; NULL leaves things as they are."""
    return F.when(error_kind.isNotNull(), error_status(error_kind)).when(
        ~http_status.isin(0, VALID_STATUS), http_status
    )


def resolve_status(domains: DataFrame, attempts: DataFrame) -> DataFrame:
    """Fold fetch attempts into ``domains`` (id, status, real_domain, ...).

    ``attempts``: domain_id, seq, http_status, page_status, error_kind,
    real_url. A fetched page always sets the status; any other code counts
    only while the status is not 200, and empties real_domain. In closed form
    per domain: the last page wins, and if it is not a 200 page then the last
    code after it does.
    """
    is_page = F.col("error_kind").isNull() & (F.col("http_status") == VALID_STATUS)
    code = attempt_code(F.col("http_status"), F.col("error_kind"))
    tie = F.struct("seq", "page_status", "real_url")
    slim = attempts.select(
        F.col("domain_id").alias("_domain_id"),
        F.when(is_page, tie).alias("_page"),
        F.when(~F.coalesce(is_page, F.lit(False)) & code.isNotNull(), F.struct(F.col("seq"), code.alias("code"))).alias("_code"),
    )
    # max over structs pre-aggregates on the map side, so a domain with many
    # attempts sends one row per task.
    folded = slim.groupBy("_domain_id").agg(F.max("_page").alias("_page"), F.max("_code").alias("_code"))
    page, last = F.col("_page"), F.col("_code")
    page_ok = page["page_status"] == VALID_STATUS
    from_code = (
        last.isNotNull()
        & F.coalesce(~page_ok & (last["seq"] > page["seq"]), page.isNull() & ~F.coalesce(F.col("status") == VALID_STATUS, F.lit(False)))
    )
    status = (
        F.when(from_code, last["code"])
        .when(page.isNotNull(), page["page_status"])
        .otherwise(F.col("status"))
        .cast("int")
    )
    real = (
        F.when(from_code, F.lit(""))
        .when(page.isNotNull(), page["real_url"])
        .otherwise(F.col("real_domain"))
    )
    return domains.join(folded, domains["id"] == folded["_domain_id"], "left").select(
        *[
            status.alias("status") if c == "status" else real.alias("real_domain") if c == "real_domain" else domains[c]
            for c in domains.columns
        ]
    )
