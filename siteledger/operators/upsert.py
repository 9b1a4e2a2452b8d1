"""Keyed writes as DataFrame operators: existing rows and updates in, new table out.

``seq`` orders the updates; ties are broken by the remaining columns. Updates
are first reduced to one row per key by aggregates that combine on the map
side, so a key with a third of all updates reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import staged

# Parts into which the rows of one key are spread where a join needs all of them.
SALTS = 32


def _order(df: DataFrame, seq: str, keys: Sequence[str] = ()) -> Column:
    """Total order of update rows: seq first, then every other column."""
    rest = sorted(c for c in df.columns if c != seq and c not in keys)
    return F.struct(F.col(seq), *[F.col(f"`{c}`") for c in rest])


def _one_per_key(df: DataFrame, keys: Sequence[str], seq: str, pick, *more: Column) -> DataFrame:
    """The first (F.min) or last (F.max) row of each key, with more aggregates."""
    rows = df.groupBy(*keys).agg(pick(_order(df, seq, keys)).alias("_row"), *more)
    fields = [F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    return rows.select(*fields, *rows.columns[len(keys) + 1:])


def last_per_key(df: DataFrame, keys: Sequence[str], seq: str, first_seq: str | None = None) -> DataFrame:
    """The row with the highest seq of each key; ``first_seq`` names a column for the lowest one."""
    return _one_per_key(df, keys, seq, F.max, *([F.min(seq).alias(first_seq)] if first_seq else []))


def first_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row with the lowest seq of each key."""
    return _one_per_key(df, keys, seq, F.min)


def _merge(existing: DataFrame, changes: DataFrame, keys: Mapping[str, str], value, id_col: str | None, above: int = 0) -> DataFrame:
    """Existing rows changed and new ones added; ``changes`` has one row per key.

    ``keys`` maps key columns to those of the changes, ``value`` gives each
    output column from the joined row. With ``id_col`` new rows get the next
    free ids; only the changes are staged for that, never the table. Where
    ``existing`` is a part of the table, ``above`` is the highest id in use.
    """
    on = [F.col(k) == F.col(c) for k, c in keys.items()]
    types = {f.name: f.dataType for f in existing.schema.fields}

    def pick(joined: DataFrame) -> DataFrame:
        return joined.select(*[value(c).cast(types[c]).alias(c) for c in existing.columns])

    if id_col is None:
        return pick(existing.join(changes, on, "full_outer"))
    changes = staged(changes)
    new = changes.join(existing.select(*keys), on, "left_anti").select(
        "*", *[F.lit(None).cast(types[c]).alias(c) for c in existing.columns]
    )
    return pick(existing.join(changes, on, "left")).unionByName(_numbered(existing, pick(new), list(keys), id_col, above))


def _numbered(existing: DataFrame, new: DataFrame, order: Sequence[str], id_col: str, above: int = 0) -> DataFrame:
    """New rows with ids that follow the highest one of the table."""
    start = max(existing.agg(F.max(id_col)).first()[0] or 0, above)
    return assign_ids(new.drop(id_col), start, order, id_col)


def upsert(
    existing: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str], seq: str,
    id_col: str | None = None,
) -> DataFrame:
    """Last write wins on ``update_cols``; a known key keeps its other columns.

    A new key takes every column the first update of the key has, then the
    update columns of the last one. Columns missing from the updates stay
    NULL on new rows, but for ``id_col``, which then gets the next free ids.
    """
    given = [c for c in existing.columns if c in updates.columns and c not in keys]
    on_insert = [c for c in given if c not in update_cols]
    slim = updates.select(*keys, *[c for c in given if c != seq], seq)
    order = _order(slim, seq, keys)
    aggregates = [F.max(order).alias("_last")]
    if on_insert:
        aggregates.append(F.min(order).alias("_first"))
    u = slim.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(*aggregates)
    is_update, is_new = F.col("_last").isNotNull(), reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(c), F.col(f"_k_{c}"))
        if c in update_cols and c in given:
            return F.when(is_update, F.col("_last").getField(c)).otherwise(F.col(c))
        if c in on_insert:
            return F.when(is_update & is_new, F.col("_first").getField(c)).otherwise(F.col(c))
        return F.col(c)

    return _merge(existing, u, {k: f"_k_{k}" for k in keys}, value, id_col)


def insert_ignore(
    existing: DataFrame, rows: DataFrame, keys: Sequence[str], seq: str, id_col: str | None = None, above: int = 0
) -> DataFrame:
    """Keep-first: rows with a known key change nothing, the first new one is added."""
    new = first_per_key(rows, keys, seq).join(existing.select(*keys), list(keys), "left_anti")
    new = new.select(*[c for c in existing.columns if c in new.columns])
    if id_col is not None:
        new = _numbered(existing, new, keys, id_col, above)
    return existing.unionByName(new, allowMissingColumns=True)


def upsert_inns(
    existing: DataFrame, rows: DataFrame, seq: str, id_col: str | None = None, above: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Owners of tax ids: (new table, rejected rows).

    ``rows``: inn, domain_id, seq. A row with a domain sets the owner (last
    one wins). A row without one (NULL or 0) only adds an unknown tax id; for
    a known one it is a duplicate and is rejected.
    """
    has_domain = F.coalesce(F.col("domain_id") != 0, F.lit(False))
    per_inn = rows.groupBy(F.col("inn").alias("_inn")).agg(
        F.min(seq).alias("_first_seq"),
        F.max(F.when(has_domain, F.struct(F.col(seq), F.col("domain_id")))).alias("_owner"),
    )

    def value(c: str) -> Column:
        if c == "domain_id":
            return F.coalesce(F.col("_owner")["domain_id"], F.col("domain_id"))
        return F.coalesce("inn", "_inn") if c == "inn" else F.col(c)

    table = _merge(existing, per_inn, {"inn": "_inn"}, value, id_col, above)
    plain = rows.where(~has_domain)
    # Staged, so that the join of the single rows has plain shuffles on both sides and splits a hot tax id.
    first = staged(per_inn.select("_inn", "_first_seq").join(
        existing.select(F.col("inn").alias("_inn"), F.lit(True).alias("_known")), "_inn", "left"
    ))
    rejected = plain.join(first, F.col("inn") == F.col("_inn")).where(
        F.coalesce(F.col("_known"), F.lit(False)) | (F.col(seq) > F.col("_first_seq"))
    )
    return table, rejected.select(*rows.columns)


def upsert_domain_info(
    existing: DataFrame, rows: DataFrame, seq: str, first_seq: str | None = None, id_col: str | None = None, above: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Site rows under two unique keys, domain_id and real_domain: (new table, rejects).

    ``rows`` has domain_id, real_domain, seq and value columns of the table.
    Of several rows of one domain the last one gives the values and the first
    one (or the column ``first_seq``) the time from which it claims its
    real_domain. A row
    - of a known domain updates that row, real_domain included;
    - of a new domain with a known real_domain updates the owner of it, which
      keeps its own domain_id;
    - with neither known is added.
    A known domain that moves to a real_domain held by another row is rejected,
    as both rows cannot keep it. Rows act in ``seq`` order; a real_domain that
    its owner leaves in this same batch still counts as held for other known
    domains, which then can be sent again. NULL real_domains never clash.
    """
    values = [c for c in existing.columns if c in rows.columns and c not in ("id", "domain_id", "real_domain")]
    slim = rows.select("domain_id", "real_domain", seq, *values, F.col(first_seq or seq).alias("_since"))
    batch = slim.groupBy("domain_id").agg(
        F.max(_order(slim.drop("_since"), seq, ["domain_id"])).alias("_last"), F.min("_since").alias("_since")
    ).select("domain_id", *[F.col("_last").getField(c).alias(c) for c in ["real_domain", seq, *values]], "_since")
    body = F.struct(F.col("real_domain"), *[F.col(c) for c in values])

    by_domain = existing.select(
        F.col("domain_id").alias("_d"), F.col("real_domain").alias("_old"), F.lit(True).alias("_known")
    ).where(F.col("_d").isNotNull())
    # Written once, as what follows looks at these rows from several sides.
    placed = staged(batch.join(by_domain, F.col("domain_id") == F.col("_d"), "left").select(
        "domain_id", "real_domain", F.col(seq).alias("_seq"), "_since", body.alias("_body"),
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_old").eqNullSafe(F.col("real_domain")), "stay")
        .when(F.col("real_domain").isNull(), "leave")
        .otherwise("move").alias("_kind"),
    ))
    kind = F.col("_kind")
    is_claim = F.col("real_domain").isNotNull() & kind.isin("new", "move")

    # One row per wanted real_domain, combined on the map side, before the
    # holders are looked up: a name wanted by a third of all rows stays cheap.
    wanted = placed.where(is_claim).groupBy("real_domain").agg(
        F.min(F.struct("_since", "domain_id", "_kind")).alias("_first"),
        F.min(F.when(kind == "move", F.struct("_since", "domain_id", "_seq", "_body"))).alias("_mover"),
        F.max(F.when(kind == "new", F.struct("_seq", "_body"))).alias("_newest"),
    )
    holders = existing.where(F.col("real_domain").isNotNull()).select(
        F.col("real_domain").alias("_r"), F.col("domain_id").alias("_owner"), F.lit(True).alias("_held")
    )
    claims = staged(wanted.join(holders, F.col("real_domain") == F.col("_r"), "left"))

    # Free real_domains: the first row takes it. If a mover does, new rows
    # update it; if a new row does, movers are rejected.
    free = claims.where(F.col("_held").isNull())
    mover_wins = F.col("_first")["_kind"] == "move"
    mover = F.when(mover_wins, F.struct(F.col("_mover")["_seq"].alias("_seq"), F.col("_mover")["_body"].alias("_body")))
    last_claim = F.greatest(mover, F.col("_newest"))
    claimed = free.select(
        F.col("_first")["domain_id"].alias("_target"), last_claim["_seq"].alias("_seq"), last_claim["_body"].alias("_body")
    )
    moved = free.where(mover_wins).select(
        F.col("_mover")["domain_id"].alias("_moved"), F.col("_mover")["_since"].alias("_moved_at")
    ).unionByName(
        placed.where(kind == "leave").select(F.col("domain_id").alias("_moved"), F.col("_since").alias("_moved_at"))
    )

    # Held real_domains: new rows update the owner that stays.
    held = claims.where(F.col("_held") & F.col("_newest").isNotNull()).join(moved, F.col("_owner") == F.col("_moved"), "left")
    hosted = held.where(F.col("_moved").isNull()).select(
        F.col("_owner").alias("_target"), F.col("_newest")["_seq"].alias("_seq"), F.col("_newest")["_body"].alias("_body")
    )
    # Where the owner moves away, rows before that are overwritten by its own;
    # the first row after it takes the name. These few names meet their rows
    # salted, so that a much wanted one is spread over the tasks.
    salt = F.pmod(F.xxhash64("domain_id"), F.lit(SALTS))
    left = held.where(F.col("_moved").isNotNull()).select(
        F.col("real_domain").alias("_left"), "_moved_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_salt")
    )
    after = (
        placed.where(is_claim & (kind == "new")).withColumn("_s", salt)
        .join(left, (F.col("real_domain") == F.col("_left")) & (F.col("_s") == F.col("_salt")))
        .where(F.col("_seq") > F.col("_moved_at"))
        .groupBy("real_domain")
        .agg(
            F.min(F.struct(F.greatest("_since", "_moved_at"), F.col("domain_id")))["domain_id"].alias("_target"),
            F.max(F.struct("_seq", "_body")).alias("_last"),
        )
        .select("_target", F.col("_last")["_seq"].alias("_seq"), F.col("_last")["_body"].alias("_body"))
    )
    own = placed.where(kind.isin("stay", "leave") | F.col("real_domain").isNull()).select(
        F.col("domain_id").alias("_target"), "_seq", "_body"
    )

    changes = (
        own.unionByName(claimed).unionByName(hosted).unionByName(after)
        .groupBy("_target").agg(F.max(F.struct("_seq", "_body")).alias("_last"))
        .select("_target", F.col("_last")["_body"].alias("_new"))
    )
    def value(c: str) -> Column:
        if c == "domain_id":
            return F.coalesce("domain_id", "_target")
        if c == "real_domain" or c in values:
            return F.when(F.col("_new").isNotNull(), F.col("_new").getField(c)).otherwise(F.col(c))
        return F.col(c)

    table = _merge(existing, changes, {"domain_id": "_target"}, value, id_col, above)
    movers = placed.where(kind == "move").join(moved, F.col("domain_id") == F.col("_moved"), "left_anti")
    rejects = movers.select("domain_id", "real_domain", F.col("_seq").alias(seq), *[F.col("_body").getField(c).alias(c) for c in values])
    return table, rejects


def dedupe_real_domain(info: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """One row per real_domain: the given id (real_domain, id), else the lowest.

    With ``keep`` only the listed real_domains lose rows. NULLs never match.
    """
    if keep is not None:
        kept = keep.select(F.col("real_domain").alias("_r"), F.col("id").alias("_keep"))
        joined = info.join(kept, F.col("real_domain") == F.col("_r"), "left")
        return joined.where(F.col("_keep").isNull() | (F.col("id") == F.col("_keep"))).select(*info.columns)
    # Narrow rows find the losers; the wide ones are joined on the unique id.
    lowest = info.where(F.col("real_domain").isNotNull()).groupBy("real_domain").agg(F.min("id").alias("id"))
    named = info.where(F.col("real_domain").isNotNull()).join(lowest.select("id"), "id", "left_semi")
    return named.unionByName(info.where(F.col("real_domain").isNull()))


def assign_ids(new: DataFrame, start: int, order: Sequence[str], id_col: str = "id") -> DataFrame:
    """Dense ids ``start`` + 1, + 2, ... in the given order.

    Rows are range-partitioned and written once to the shared folder, so that
    counting and numbering see the same partitions even when an executor is
    lost. Only one count per partition is brought together.
    """
    rest = sorted(c for c in new.columns if c not in order)
    by = [F.col(c) for c in [*order, *rest]]
    ranged = new.repartitionByRange(*by).sortWithinPartitions(*by)
    stable = staged(ranged.withColumn("_mono", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_mono", 33))
    # One row per partition; the window runs over those rows only.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stable.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    row = F.col("_mono") - F.shiftleft(F.col("_part"), 33)
    return stable.join(F.broadcast(offsets), "_part").select((F.col("_before") + row + (start + 1)).alias(id_col), *new.columns)


def explode_contacts(features: DataFrame) -> dict[str, DataFrame]:
    """One row per contact: tables domain_phones, domain_emails, domain_inns, inns."""
    order = [c for c in ("seq",) if c in features.columns]

    def rows(array: str, name: str) -> DataFrame:
        return features.select("domain_id", *order, F.explode(array).alias(name))

    mails = rows("emails", "email").withColumn("email", F.trim("email"))
    found = rows("inns", "inn")
    return {"domain_phones": rows("phones", "number"), "domain_emails": mails, "domain_inns": found, "inns": found}
