"""Checked table writes.

``append`` writes unconditionally. The other modes stage the rows first and check them against
the table's declaration: no null in a NOT NULL column, no key twice in the batch, its further keys
(the ids of a dimension) included.

* ``error``: fail when a key exists already; nothing is written.
* ``skip``: write only rows whose key is absent, so a second run adds nothing.
* ``replace``: overwrite whole periods, so a second run gives the same table.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.operators.dims import insert_if_absent
from skylattice.schemas import Table, declared, to_table
from skylattice.sources.tables import CatalogStore, FileStore, JdbcStore
from skylattice.storage import staged

MODES = ("append", "error", "skip", "replace")


class WriteConflict(ValueError):
    """Rows violate the table's declaration or clash with rows it holds."""


def write_table(
    store: FileStore | CatalogStore | JdbcStore,
    df: DataFrame,
    name: str,
    on_conflict: str = "error",
    within: Column | None = None,
    stored: bool = False,
    order: list[Column] | None = None,
) -> None:
    """Write ``df`` to table ``name`` of ``store``.

    ``within`` is a predicate on the table's partition columns that holds for every new row. It
    limits the look-up of existing keys to the partitions concerned and tells ``replace`` which
    periods to overwrite. ``stored`` says that ``df`` derives cheaply from stored rows and
    need not be staged. With ``order`` and ``skip`` a key may stand twice in the batch: the first row wins.
    """
    if on_conflict not in MODES:
        raise ValueError(f"on_conflict must be one of {MODES}, not {on_conflict!r}")
    table = declared(name)
    rows = to_table(df, table)
    if on_conflict == "append":
        store.append(rows, table)
        return
    if on_conflict == "replace" and not (isinstance(store, FileStore | CatalogStore) and table.partition_by and within is not None):
        raise ValueError("replace needs a partitioned file or catalog table and the predicate within")
    with nullcontext(rows) if stored else staged(rows) as fresh:
        _check(fresh, table, within, once=order is None or on_conflict != "skip")
        if on_conflict == "replace":
            store.replace(fresh, table, within)
            return
        existing = store.held(name)
        existing = existing if within is None else existing.filter(within)
        if on_conflict == "error":
            _refuse(fresh, existing, name, table.keys)
        else:
            fresh = insert_if_absent(fresh, existing, list(table.keys), order)
        for key in table.unique:
            _refuse(fresh, existing, name, key)
        store.append(to_table(fresh, table), table)


def _refuse(rows: DataFrame, existing: DataFrame, name: str, key: tuple[str, ...]) -> None:
    clash = rows.join(existing.select(*key), list(key), "left_semi").take(3)
    if clash:
        raise WriteConflict(f"{name}: key exists ({', '.join(key)}), e.g. {clash}")


def _check(rows: DataFrame, table: Table, within: Column | None, once: bool) -> None:
    """Count all violations in one pass, by key, and raise if there are any."""
    broken = {f"null in NOT NULL column {c}": F.col(c).isNull() for c in table.not_null}
    if within is not None:
        broken["row outside the given period"] = ~within
    counted = [F.count_if(broke).alias(what) for what, broke in broken.items()]
    keys = (table.keys, *table.unique)
    columns = list(dict.fromkeys(c for key in keys for c in key))
    # All keys in one pass, told apart by which columns a group leaves out.
    marks = [int("".join("0" if c in key else "1" for c in columns), 2) for key in keys]
    sets = [[F.col(c) for c in key] for key in keys]
    per_key = rows.groupingSets(sets, *columns).agg(F.count("*").alias("_n"), F.grouping_id().alias("_set"), *counted)
    twice = {
        f"key twice in the batch ({', '.join(key)})": (F.col("_n") > 1) & (F.col("_set") == mark) & F.lit(once or mark != marks[0])
        for key, mark in zip(keys, marks, strict=True)
    }
    found = per_key.agg(
        *(F.sum(F.when(F.col("_set") == marks[0], F.col(f"`{what}`"))).alias(what) for what in broken),
        *(F.count_if(double).alias(what) for what, double in twice.items()),
    ).first()
    problems = [f"{n} x {what}" for what, n in found.asDict().items() if n]
    if problems:
        raise WriteConflict(f"{table.name}: {', '.join(problems)}")
