"""Declarative data-quality checks (DQ-1..28) evaluated in as few passes as possible.

A check is data (``Check``).  ``run_checks`` turns a list of checks over named
tables into a result with a row per check ``(check_id, model, kind,
column_name, severity, failures, status)``:

* all row-level checks of a table (not_null, ranges, positivity, future dates,
  date order, regex/like, row-level sets) are fused into a single aggregation
  — one scan, one conditional sum per check, a one-row result;
* all ``unique`` / ``unique_combination`` / ``duplicates`` checks of a table share
  one grouped count over (check, 64-bit hash of the key): one shuffle whatever
  their number.  Only keys with an equal hash, and keys on columns with a
  collation, are counted by value;
* ``accepted_values`` is a grouped count whose partial aggregation runs
  map-side, so only distinct values are shuffled;
* ``relationships`` / ``orphans`` are left-anti joins against the parent's
  distinct keys;
* whole-table checks (row count, mean, recency, completeness) join the fused
  aggregation; schema checks (column exists / type) need no scan.

``failures`` follows the convention that a test is a query returning failing
rows: rows for row-level checks, distinct offending values for
``unique``/``accepted_values``, 1 for a failed table-level check.  A check that
cannot be evaluated has status ``error`` and no number of failures; the others
still report.  What is not a check's own fault (a full disk, a lost executor, a
cancelled job) is no result: it is raised.

``record_run`` appends a run's results to a stored history, ``run_trend`` sets
each against the run before.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.text import is_collated, plain

ROW_KINDS = {"not_null", "accepted_range", "is_positive", "no_future_dates", "valid_date_range",
             "non_negative", "regex", "like", "between", "in_set"}
GROUP_KINDS = {"unique", "accepted_values", "unique_combination", "duplicates"}
UNIQUE_KINDS = {"unique", "unique_combination", "duplicates"}
JOIN_KINDS = {"relationships", "orphans"}
TABLE_KINDS = {"row_count_between", "mean_between", "recency", "equal_rowcount", "completeness",
               "table_exists"}
SCHEMA_KINDS = {"column_exists", "column_type"}

RESULT_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
])


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict, hash=False, compare=False)
    severity: str = "error"

    @property
    def check_id(self) -> str:
        extra = ""
        p = self.params
        if self.kind == "valid_date_range":
            extra = f"{p['start']}__{p['end']}"
        elif self.kind in ("unique_combination", "duplicates"):
            extra = "__".join(p["columns"])
        elif self.kind == "orphans":
            extra = "__".join(p["columns"]) + "__" + p["to"]
        elif self.kind == "equal_rowcount":
            extra = p["to"]
        if p.get("name"):
            extra = f"{extra}__{p['name']}" if extra else p["name"]
            return ".".join(x for x in (self.model, self.kind, self.column, extra) if x)
        return ".".join(x for x in (self.model, self.kind, self.column or extra) if x)


def _col(df: DataFrame, name: str) -> Column:
    return df[name]


def _spelled(df: DataFrame, name: str) -> Column:
    """The column as it is spelled: patterns are matched without regard to a collation."""
    return plain(df[name]) if is_collated(df, name) else df[name]


def _is_bool(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.BooleanType)


def _values_expr(df: DataFrame, name: str, values, case_insensitive: bool = False) -> Column:
    """Membership test; ``case_insensitive`` compares as the source database's default
    collation does (case and trailing blanks ignored)."""
    c = df[name]
    if _is_bool(df, name):
        c = c.cast("int")
    if case_insensitive:
        return F.upper(F.rtrim(c)).isin([str(v).rstrip().upper() for v in values])
    return c.isin(list(values))


def fail_condition(df: DataFrame, chk: Check, as_of_date: Column) -> Column:
    """Row-level failing predicate (NULL inputs pass unless the check is not_null)."""
    p, k = chk.params, chk.kind
    if k == "not_null":
        return df[chk.column].isNull()
    if k in ("accepted_range", "between"):
        c = df[chk.column]
        cond = F.lit(False)
        if p.get("min") is not None:
            cond = cond | (c < F.lit(p["min"]))
        if p.get("max") is not None:
            cond = cond | (c > F.lit(p["max"]))
        return cond
    if k == "is_positive":
        return df[chk.column] <= 0
    if k == "non_negative":
        return df[chk.column] < 0
    if k == "no_future_dates":
        return df[chk.column] > as_of_date
    if k == "valid_date_range":
        s, e = df[p["start"]], df[p["end"]]
        return s.isNotNull() & e.isNotNull() & (s.cast("date") > e.cast("date"))
    if k == "regex":
        return ~_spelled(df, chk.column).rlike(p["pattern"])
    if k == "like":
        return ~_spelled(df, chk.column).like(p["pattern"])
    if k == "in_set":
        return ~_values_expr(df, chk.column, p["values"], p.get("case_insensitive", False))
    raise ValueError(k)


def _lit_row(chk: Check, failures: Column) -> Column:
    return F.struct(F.lit(chk.check_id).alias("check_id"), F.lit(chk.model).alias("model"),
                    F.lit(chk.kind).alias("kind"), F.lit(chk.column).cast("string").alias("column_name"),
                    F.lit(chk.severity).alias("severity"), failures.cast("bigint").alias("failures"))


def _rows(one_row: DataFrame, checks: list[Check], cols: list[str]) -> DataFrame:
    """Turn a one-row aggregate (one column per check) into one result row per check."""
    structs = [_lit_row(c, F.col(n)) for c, n in zip(checks, cols)]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _key_columns(chk: Check) -> list[str]:
    return [chk.column] if chk.kind == "unique" else list(chk.params["columns"])


def _keyed(df: DataFrame, chk: Check) -> DataFrame:
    """The rows a uniqueness check counts: ``unique`` passes over null values, combinations count them."""
    return df.filter(df[chk.column].isNotNull()) if chk.kind == "unique" else df


#: Fixed value: most repeated hashes that reach the driver; with more, all keys are counted by value.
MOST_REPEATED = 100_000


def _repeats(df: DataFrame, checks: list[Check]) -> dict[int, list[int] | None]:
    """The hashes that more than one row has, by position of the uniqueness check, in one shuffle for all; None for too many."""
    keys = []
    for i, chk in enumerate(checks):
        columns = [df[c] for c in _key_columns(chk)]
        key = F.struct(F.lit(i).alias("i"), F.xxhash64(*columns).alias("h"))
        keys.append(F.when(columns[0].isNotNull(), key) if chk.kind == "unique" else key)
    rows = df.select(F.explode(F.array(*keys)).alias("k")).where("k IS NOT NULL").groupBy("k.i", "k.h").count().where("count > 1")
    some = rows.select("i", "h").limit(MOST_REPEATED + 1).collect()
    if len(some) > MOST_REPEATED:
        return dict.fromkeys(r["i"] for r in rows.select("i").distinct().collect())  # at most one row a check
    out: dict[int, list[int] | None] = {}
    for r in some:
        out.setdefault(r["i"], []).append(r["h"])
    return out


def _repeated_hashes(df: DataFrame, checks: list[Check]) -> set[int]:
    """Positions of the uniqueness checks in which two rows' keys have one hash."""
    return set(_repeats(df, checks))


def _with_hashes(df: DataFrame, chk: Check, hashes: list[int] | None) -> DataFrame:
    """The rows whose key has one of the hashes: every row of a repeated key is among them.  All rows for None."""
    if hashes is None:
        return df
    again = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hashes], "_again long"))
    return df.join(again, F.xxhash64(*[df[c] for c in _key_columns(chk)]) == again["_again"], "left_semi")


def _group_check(df: DataFrame, chk: Check) -> DataFrame:
    p = chk.params
    if chk.kind in UNIQUE_KINDS:
        bad = duplicates(_keyed(df, chk), _key_columns(chk))
    elif chk.kind == "accepted_values":
        v = df[chk.column]
        bad = (df.filter(v.isNotNull() & ~_values_expr(df, chk.column, p["values"],
                                                       p.get("case_insensitive", False)))
               .groupBy(chk.column).count())
    else:
        raise ValueError(chk.kind)
    return _rows(bad.agg(F.count(F.lit(1)).alias("n")), [chk], ["n"])


def _join_check(df: DataFrame, chk: Check, tables: dict[str, DataFrame]) -> DataFrame:
    p = chk.params
    parent = tables[p["to"]]
    if chk.kind == "relationships":
        child_cols, parent_cols = [chk.column], [p["field"]]
    else:
        child_cols, parent_cols = list(p["columns"]), list(p.get("fields", p["columns"]))
    keys = parent.select(*[F.col(pc).alias(f"k{i}") for i, pc in enumerate(parent_cols)]).distinct()
    child = df.filter(reduce(lambda a, b: a & b, [df[c].isNotNull() for c in child_cols]))
    # pre-aggregate the child to (key, rows): the anti-join then shuffles one row
    # per key and task instead of every child row, and a hot key is collapsed map-side
    grouped = child.groupBy(*child_cols).agg(F.count(F.lit(1)).alias("_rows"))
    cond = reduce(lambda a, b: a & b, [grouped[c] == keys[f"k{i}"] for i, c in enumerate(child_cols)])
    bad = grouped.join(keys, cond, "left_anti")
    return _rows(bad.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")), [chk], ["n"])


def _outside(value: Column, p: dict) -> Column:
    bad = F.lit(False)
    if p.get("min") is not None:
        bad = bad | (value < p["min"])
    if p.get("max") is not None:
        bad = bad | (value > p["max"])
    return bad


def _whole_table(df: DataFrame, chk: Check, as_of_ts: Column) -> Column:
    """Aggregate that is 1 if the table as a whole fails; it joins the table's one fused aggregate."""
    p, k = chk.params, chk.kind
    rows = F.count(F.lit(1))
    if k == "row_count_between":
        bad = _outside(rows, p)
    elif k == "table_exists":
        bad = rows < 0  # reading the table is the check: that it cannot be read is its failure
    elif k == "mean_between":
        bad = _outside(F.sum(df[chk.column]).cast("double") / F.nullif(F.count(df[chk.column]), F.lit(0)), p)
    elif k == "recency":
        newest = F.max(df[chk.column]).cast("timestamp_ntz")
        limit = as_of_ts - F.expr(f"INTERVAL {int(p['count'])} {p.get('period', 'day').upper()}")
        bad = newest.isNull() | (newest < limit)
    elif k == "completeness":
        share = F.count(df[chk.column]).cast("double") / F.nullif(rows, F.lit(0))
        bad = share.isNull() | (share < p["min_share"])
    else:
        raise ValueError(k)
    return F.when(bad, 1).otherwise(0)  # a mean of nothing is not outside


def _equal_rowcount(df: DataFrame, chk: Check, tables: dict[str, DataFrame]) -> DataFrame:
    # +1 per row here, -1 per row there: equal counts sum to zero (no join needed)
    signed = df.select(F.lit(1).alias("d")).unionByName(tables[chk.params["to"]].select(F.lit(-1).alias("d")))
    one = signed.agg(F.when(F.coalesce(F.sum("d"), F.lit(0)) != 0, 1).otherwise(0).alias("n"))
    return _rows(one, [chk], ["n"])


#: Kinds evaluated as one aggregate each, of which run_checks makes one query.
_COUNTED = JOIN_KINDS | {"equal_rowcount"}


def counted_together(tables: dict[str, DataFrame], checks: list[Check], as_of=None) -> DataFrame:
    """(i, failures): whole-table and join checks by position, as one query.

    The parts are aggregates over models that are mostly built from the same sources by the same keys; as one
    query, an exchange that several of them plan alike is made once and read by all.
    """
    from salesmart.functions.dates import as_of_ts as _t
    whole: dict[str, list[int]] = {}
    parts = []
    for i, c in enumerate(checks):
        if c.kind in _COUNTED:
            part = _equal_rowcount(tables[c.model], c, tables) if c.kind == "equal_rowcount" else _join_check(tables[c.model], c, tables)
            parts.append(part.select(F.lit(i).alias("i"), "failures"))
        else:
            whole.setdefault(c.model, []).append(i)
    for model, some in whole.items():
        one = tables[model].agg(*[_whole_table(tables[model], checks[i], _t(as_of)).alias(f"t{i}") for i in some])
        rows = [F.struct(F.lit(i).alias("i"), F.col(f"t{i}").cast("bigint").alias("failures")) for i in some]
        parts.append(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def _schema_failures(df: DataFrame, chk: Check) -> int:
    ok = chk.column in df.columns
    if ok and chk.kind == "column_type":
        ok = df.schema[chk.column].dataType.simpleString() == chk.params["type"]
    return 0 if ok else 1


#: Kinds whose failures are rows (or values) of their table.
FAILING_ROW_KINDS = ROW_KINDS | GROUP_KINDS | JOIN_KINDS


def failing_rows(df: DataFrame, chk: Check, as_of=None, tables: dict[str, DataFrame] | None = None,
                 hashes: list[int] | None = None) -> DataFrame:
    """The failing rows of a check, all columns: a test is a query that returns its failing rows.

    Uniqueness checks return every row of a repeated key, ``relationships`` and
    ``orphans`` the rows without a parent in ``tables``, ``accepted_values`` the
    rows with another value.  Checks of a whole table have no failing rows.
    ``hashes`` are those of a uniqueness check's repeated keys, if they are known.
    """
    from salesmart.functions.dates import as_of_date as _d
    p = chk.params
    if chk.kind in UNIQUE_KINDS:
        columns, df = _key_columns(chk), _with_hashes(df, chk, hashes)
        named = duplicates(_keyed(df, chk), columns).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
        same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(columns)])
        return df.join(named, same, "left_semi")
    if chk.kind == "accepted_values":
        return df.filter(df[chk.column].isNotNull() & ~_values_expr(df, chk.column, p["values"], p.get("case_insensitive", False)))
    if chk.kind in JOIN_KINDS:
        columns = [chk.column] if chk.kind == "relationships" else list(p["columns"])
        fields = [p["field"]] if chk.kind == "relationships" else list(p.get("fields", columns))
        parents = tables[p["to"]].select(*[F.col(f).alias(f"_k{i}") for i, f in enumerate(fields)]).distinct()
        same = reduce(lambda a, b: a & b, [df[c] == F.col(f"_k{i}") for i, c in enumerate(columns)])
        given = reduce(lambda a, b: a & b, [df[c].isNotNull() for c in columns])
        return df.filter(given).join(parents, same, "left_anti")
    if chk.kind in ROW_KINDS:
        return df.filter(fail_condition(df, chk, _d(as_of)))
    raise ValueError(f"{chk.kind} is a check of a whole table")


def failures_by_key(tables: dict[str, DataFrame], checks: list[Check], keys: dict[str, str], as_of=None,
                    hashes: dict[str, list[int] | None] | None = None) -> DataFrame:
    """(check_id, row_key): the failing rows of all ``checks`` by each model's key column."""
    parts = [failing_rows(tables[c.model], c, as_of, tables, (hashes or {}).get(c.check_id)).select(
        F.lit(c.check_id).alias("check_id"), F.col(keys[c.model]).cast("string").alias("row_key")) for c in checks]
    spark = next(iter(tables.values())).sparkSession
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], "check_id string, row_key string"))


def failed_rows(tables: dict[str, DataFrame], checks: list[Check], keys: dict[str, str], as_of=None, parallelism: int = 8) -> DataFrame:
    """The failing rows by key of every check that fails, whichever it is; checks that pass are not read twice.

    Raises if a check cannot be evaluated: without its rows the result would look like that of a check that passes.
    """
    hashes: dict[str, list[int] | None] = {}
    results = (run_checks(tables, checks, as_of, parallelism, hashes).where("failures > 0 OR status = 'error'")
               .select("check_id", "status").collect())
    unknown = sorted(r["check_id"] for r in results if r["status"] == "error")
    if unknown:
        raise RuntimeError(f"the failing rows of checks that cannot be evaluated are not known: {', '.join(unknown)}")
    bad = {r["check_id"] for r in results}
    return failures_by_key(tables, [c for c in checks if c.check_id in bad and c.kind in FAILING_ROW_KINDS], keys, as_of, hashes)


def record_run(results: DataFrame, path: str, run: str, run_at: str) -> None:
    """Append a run's results to the stored history, one folder a run; writing a run again replaces it."""
    (results.withColumn("run_at", F.to_timestamp_ntz(F.lit(run_at)))
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}"))


def run_trend(history: DataFrame) -> DataFrame:
    """Each run's results beside the previous run's of the same check, and what has changed.

    ``change`` is the difference of failures (null if either is not known).
    ``trend`` is first, same, better, worse, fixed, broken (passed before) or
    error (not evaluated).  Checks with the same id in one run are told apart by
    nothing, so ids must be unique in a run.
    """
    by_check = Window.partitionBy("check_id").orderBy("run_at", "run")  # as many rows as there are runs
    before, now = F.lag("failures").over(by_check), F.col("failures")
    rows = history.select("run", "run_at", "check_id", "status", "failures", F.row_number().over(by_check).alias("n"),
                          before.alias("previous_failures"), F.lag("status").over(by_check).alias("previous_status"))
    was_bad = F.col("previous_status") != "pass"
    trend = (F.when(F.col("status") == "error", "error").when(F.col("n") == 1, "first")
             .when((F.col("status") == "pass") & was_bad, "fixed").when((F.col("status") != "pass") & ~was_bad, "broken")
             .when(now < F.col("previous_failures"), "better").when(now > F.col("previous_failures"), "worse")
             .otherwise("same"))
    return rows.select("run", "run_at", "check_id", "status", "failures", "previous_failures",
                       (now - F.col("previous_failures")).alias("change"), trend.alias("trend"))


def summary(results: DataFrame) -> DataFrame:
    """DQ-27: totals by status (PASS/WARN/ERROR counts) and failing rows."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"),
                                         F.sum("failures").alias("failing_rows"))


def _of_the_check(error: Exception) -> bool:
    """Whether an error is a check's own, its column, values, pattern or table, and not one of the run that evaluates it.

    Spark names the condition of errors in a query or its values; a failed job has a Java error, whose causes say why.
    """
    if not isinstance(error, Py4JError):
        return not isinstance(error, (OSError, MemoryError))
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        name = cause.getClass().getName()
        if name == "java.util.regex.PatternSyntaxException" or "[FAILED_READ_FILE." in (cause.getMessage() or ""):
            return True
        cause = cause.getCause()
    return False


def run_checks(tables: dict[str, DataFrame], checks: list[Check], as_of=None,
               parallelism: int = 8, hashes: dict[str, list[int] | None] | None = None) -> DataFrame:
    """Evaluate ``checks`` over ``tables``: one result row per check.

    * one fused aggregate per table holds all row-level and whole-table checks
      and counts the failing *rows* of every ``accepted_values`` check; the
      distinct offending values are only counted (a second, grouped pass) for
      checks whose row count is non-zero;
    * the uniqueness checks of a table share one shuffle; only those with an
      equal hash are counted by value;
    * every ``relationships`` or row-count comparison and the whole-table checks of tables without
      row-level checks are one query together, in which equal exchanges are made once;
    * schema checks read the plan's types only;
    * all checks of a table that is not there fail, and ``table_exists`` also
      fails for a table that cannot be read;
    * a check that cannot be evaluated (say, its column is absent) has status
      ``error`` and null failures, and does not hinder the others; a failure of
      the run (a full disk, a lost executor) is raised.

    The independent jobs are submitted from a small thread pool, so their
    scheduling and code generation overlap.  Only one-row aggregates and some hashes reach the driver;
    ``hashes``, if given, is filled with those of repeated keys by check id.
    """
    from concurrent.futures import ThreadPoolExecutor

    from salesmart.functions.dates import as_of_date as _d, as_of_ts as _t
    as_of_date, as_of_ts = _d(as_of), _t(as_of)
    spark = next(iter(tables.values())).sparkSession
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)

    def fused(model: str, cs: list[Check]):
        df = tables[model]
        row = [c for c in cs if c.kind in ROW_KINDS]
        whole = [c for c in cs if c.kind in TABLE_KINDS and c.kind != "equal_rowcount"]
        av = [c for c in cs if c.kind == "accepted_values"]
        probes = row + [Check(c.model, "in_set", c.column,
                              {"values": c.params["values"],
                               "case_insensitive": c.params.get("case_insensitive", False)}) for c in av]
        if not probes and not whole:
            return []
        aggs = [F.sum(F.when(fail_condition(df, c, as_of_date), 1).otherwise(0)).alias(f"c{i}")
                for i, c in enumerate(probes)]
        aggs += [_whole_table(df, c, as_of_ts).alias(f"t{i}") for i, c in enumerate(whole)]
        vals = df.agg(*aggs).first()
        out = [(c, int(vals[i] or 0)) for i, c in enumerate(row)]
        for j, c in enumerate(av):
            n_rows = int(vals[len(row) + j] or 0)
            out.append((c, 0 if n_rows == 0 else _group_check(df, c).first()["failures"]))
        return out + [(c, int(vals[f"t{i}"])) for i, c in enumerate(whole)]

    def counted(model: str, cs: list[Check]):
        failures = {r["i"]: int(r["failures"]) for r in counted_together(tables, cs, as_of).collect()}  # a row a check
        return [(c, failures[i]) for i, c in enumerate(cs)]

    def unique(model: str, cs: list[Check]):
        df = tables[model]
        repeated = _repeats(df, cs)
        # hashes know no collation: spellings of one key differ in them, so these are always counted by value
        repeated |= dict.fromkeys(i for i, c in enumerate(cs) if any(is_collated(df, k) for k in _key_columns(c)))
        if hashes is not None:
            hashes.update((cs[i].check_id, found) for i, found in repeated.items())
        return [(c, int(_group_check(_with_hashes(df, c, repeated[i]), c).first()["failures"]) if i in repeated else 0)
                for i, c in enumerate(cs)]

    def isolated(evaluate, model: str, cs: list[Check]):
        """The checks together; if that fails by one of them, each alone, and those that still fail as errors."""
        try:
            return evaluate(model, cs)
        except Exception as error:  # noqa: BLE001 - whatever keeps a check from being evaluated becomes its result
            if not _of_the_check(error):
                raise
            if len(cs) == 1:
                return [(cs[0], 1 if cs[0].kind == "table_exists" else None)]
            return [r for c in cs for r in isolated(evaluate, model, [c])]

    jobs, together = [], []
    for model, cs in by_model.items():
        if model not in tables:
            jobs.append(lambda cs=cs: [(c, 1) for c in cs])
            continue
        shared = [c for c in cs if c.kind in ROW_KINDS | {"accepted_values"} or c.kind in TABLE_KINDS - {"equal_rowcount"}]
        keyed = [c for c in cs if c.kind in UNIQUE_KINDS]
        if all(c.kind in TABLE_KINDS for c in shared):
            together += shared
            shared = []
        for evaluate, some in ((fused, shared), (unique, keyed)):
            if some:
                jobs.append(lambda f=evaluate, m=model, some=some: isolated(f, m, some))
        for c in cs:
            if c.kind in SCHEMA_KINDS:
                jobs.append(lambda m=model, c=c: [(c, _schema_failures(tables[m], c))])
            elif c.kind in _COUNTED:
                together.append(c)
    if together:
        jobs.insert(0, lambda: isolated(counted, "", together))
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = [r for part in pool.map(lambda f: f(), jobs) for r in part]
    rows = [(c.check_id, c.model, c.kind, c.column, c.severity, n) for c, n in results]
    out = spark.createDataFrame(rows, RESULT_SCHEMA)
    return out.withColumn("status", F.when(F.col("failures").isNull(), "error").when(F.col("failures") == 0, "pass")
                          .when(F.col("severity") == "warn", "warn").otherwise("fail"))


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-18/DQ-22: each duplicated key tuple with its row count (HAVING count > 1)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("dup_count")).filter(F.col("dup_count") > 1)


def run_suite(name: str, tables: dict[str, DataFrame], checks: list[Check], as_of=None) -> tuple[bool, DataFrame]:
    """DQ-26: a named list of checks run as one unit; the suite fails if any check fails."""
    results = run_checks(tables, checks, as_of).withColumn("suite", F.lit(name))
    failed = results.filter(F.col("status").isin("fail", "error")).limit(1).count() > 0
    return (not failed), results
