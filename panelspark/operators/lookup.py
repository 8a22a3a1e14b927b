"""Lookup maps: active values, substring labels and exact labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.session import broadcast_if_small, materialize


def active_values(mapping: DataFrame, key: str, value: str | None = None, order: str = "id") -> DataFrame:
    """Keys of the active rows, or key and value with the last value of a repeated key."""
    active = mapping.where(F.col("is_active") == 1)
    if value is None:
        return active.select(key)
    return active.groupBy(key).agg(F.max_by(value, order).alias(value))


def plan_sites(clinics: DataFrame) -> DataFrame:
    """Active clinics by their plan id as text, the last clinic of a repeated id."""
    return (
        clinics.where(F.col("is_active") == 1)
        .groupBy(F.col("phc_id").cast("string").alias("phc_key"))
        .agg(F.max_by("clinic_key", "id").alias("clinic_key"), F.max("id").alias("id"))
    )


def map_contained(
    df: DataFrame,
    text: str,
    mapping: DataFrame,
    key: str,
    value: str,
    out: str,
    order: str | None = None,
    last: bool = False,
    max_keys: int = 200,
    max_cells: int = 1 << 21,
) -> DataFrame:
    """The value of the first (or ``last``) map key that occurs in a text, else NULL.

    Keys rank by ``order``, which defaults to the value, then by the key; a NULL order ranks
    lowest. A NULL key occurs in no text, and a key that is found gives its value also where that is NULL. Up to
    ``max_keys`` keys the map turns into one conditional expression. A larger one becomes an automaton that
    reads each text once for all keys; both label rows in their scan, without a shuffle. A map
    whose automaton passes ``max_cells`` transitions is joined on the substrings of the
    distinct texts. A map of more than ``max_cells / 8`` rows is first reduced to the row of each key that
    ranks first (or ``last``), of equal ones by the value's text. All plans give the same labels.
    """
    ranked = mapping.where(F.col(key).isNotNull()).select(key, value, F.col(order or value).alias("_order"))
    keys = ranked.limit(max_cells // 8 + 1).collect()
    if len(keys) > max_cells // 8:
        ranked = materialize(_one_per_key(ranked, key, value, last), "lookup-keys")
        keys = ranked.limit(max_cells // 8 + 1).collect()
    if len(keys) <= max_cells // 8:
        keys = sorted(keys, key=lambda r: (r["_order"] is not None, r["_order"] if r["_order"] is not None else 0, r[key]))
        if len(keys) <= max_keys:
            return df.withColumn(out, _first_of_few(keys, mapping.schema[value].dataType, text, key, value, last))
        automaton = key_automaton([r[key] for r in keys], last, max_cells)
        if automaton is not None:
            values = [(rank, r[value]) for rank, r in enumerate(keys)]
            kind = T.StructType([T.StructField("_rank", T.IntegerType()), T.StructField(out, mapping.schema[value].dataType)])
            labels = F.broadcast(df.sparkSession.createDataFrame(values, kind))  # no more rows than max_cells / 8
            return df.withColumn("_rank", walk(text, *automaton, last)).join(labels, "_rank", "left").drop("_rank")
    by_text = _contained_by_substring(df, text, ranked, key, value, last)
    found = broadcast_if_small(materialize(by_text, "text-labels"))
    return (
        df.join(found, F.col(text) == F.col("_text"), "left")
        .withColumn(out, F.col("_found"))
        .drop("_text", "_found")
    )


def _one_per_key(ranked: DataFrame, key: str, value: str, last: bool) -> DataFrame:
    """The row of each key that can win, so that a text meets a key once however often it repeats."""
    pick = F.max_by if last else F.min_by
    best = pick(F.struct(value, "_order"), F.struct("_order", F.col(value).cast("string").alias("_text")))
    return ranked.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")


def _first_of_few(keys: list, kind: T.DataType, text: str, key: str, value: str, last: bool) -> Column:
    hits = [
        F.when(F.col(text).contains(row[key]), F.struct(F.lit(row[value]).cast(kind).alias("v")))
        for row in (reversed(keys) if last else keys)
    ]
    nothing = F.lit(None).cast(T.StructType([T.StructField("v", kind)]))
    return F.coalesce(*hits, nothing)["v"]


def key_automaton(keys: list[str], last: bool, max_cells: int) -> tuple[str, list[int], list[int]] | None:
    """An automaton that finds the best of many keys in one reading of a text; None if it has too many cells.

    Gives the letters that occur in keys, the transitions (state by state, one for each letter behind
    one for all others) and for each state the best rank of a key that ends there, -1 if none does.
    """
    alphabet = "".join(sorted({c for k in keys for c in k}))
    classes, width = {c: i + 1 for i, c in enumerate(alphabet)}, len(alphabet) + 1
    children: list[dict[int, int]] = [{}]
    best: list[int] = [-1]

    def better(a: int, b: int) -> int:
        return max(a, b) if last or min(a, b) < 0 else min(a, b)

    for rank, key in enumerate(keys):
        state = 0
        for c in key:
            state = children[state].setdefault(classes[c], len(children))
            if state == len(children):
                children.append({})
                best.append(-1)
                if len(children) * width > max_cells:
                    return None
        best[state] = better(best[state], rank)
    # Breadth first: where no key goes on, a state behaves like its longest proper end that begins a key.
    steps: list[list[int]] = [[]] * len(children)
    steps[0] = [children[0].get(c, 0) for c in range(width)]
    waiting = [(child, 0) for child in children[0].values()]
    for state, end in waiting:
        best[state] = better(best[state], best[end])
        steps[state] = [children[state].get(c, steps[end][c]) for c in range(width)]
        waiting += [(child, steps[end][c]) for c, child in children[state].items()]
    return alphabet, [s for row in steps for s in row], best


def walk(text: str, alphabet: str, steps: list[int], best: list[int], last: bool) -> Column:
    """The best rank that an automaton meets in a text, NULL if none or no text."""

    def numbers(values: list[int]) -> Column:  # folds to one literal
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")

    table, ends, width = numbers(steps), numbers(best), len(alphabet) + 1
    letters = F.filter(F.split(F.col(text), ""), lambda c: c != "")  # an empty text splits into one
    read = F.transform(letters, lambda c: F.position(c, F.lit(alphabet)))

    def step(at: Column, c: Column) -> Column:
        state = F.get(table, at["state"] * width + c)
        end = F.get(ends, state)
        kept = F.greatest(at["best"], end)
        if not last:
            kept = F.when(F.least(at["best"], end) >= 0, F.least(at["best"], end)).otherwise(kept)
        return F.struct(state.alias("state"), kept.alias("best"))

    start = F.struct(F.lit(0).alias("state"), F.lit(best[0]).alias("best"))
    return F.nullif(F.aggregate(read, start, step, lambda at: at["best"]), F.lit(-1))


def _contained_by_substring(
    df: DataFrame, text: str, ranked: DataFrame, key: str, value: str, last: bool
) -> DataFrame:
    lengths = sorted(r[0] for r in ranked.select(F.length(key)).distinct().collect())
    texts = df.select(F.col(text).alias("_text")).where(F.col(text).isNotNull()).distinct()
    pieces = (
        texts.select("_text", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("_len"))
        .where(F.length("_text") >= F.col("_len"))
        .select(
            "_text",
            "_len",
            F.explode(F.sequence(F.lit(1), F.length("_text") - F.col("_len") + 1)).alias("_at"),
        )
        .select("_text", F.expr("substring(_text, _at, _len)").alias(key))
    )
    pick = F.max_by if last else F.min_by
    return (
        pieces.join(ranked, key)
        .groupBy("_text")
        .agg(pick(F.struct(F.col(value).alias("v")), F.struct("_order", key)).alias("_hit"))
        .select("_text", F.col("_hit.v").alias("_found"))
    )


def map_trimmed(
    df: DataFrame, text: str, mapping: DataFrame, key: str, value: str, out: str, suffix: int = 5
) -> DataFrame:
    """Look a text up after dropping its last characters (a blank and a year), else NULL."""
    known = mapping.groupBy(F.col(key).alias("_key")).agg(F.max(value).alias(out))
    trimmed = F.left(F.col(text), F.greatest(F.length(text) - suffix, F.lit(0)))
    return df.join(broadcast_if_small(known), trimmed == F.col("_key"), "left").drop("_key")


def label(value: Column, text: Column) -> Column:
    """The mapped value as text, or the raw text that found no key."""
    return F.coalesce(value.cast("string"), text)


def required(value: Column, text: Column) -> Column:
    """The mapped value; a text that found no key fails the job."""
    message = F.concat(F.lit("no map key in: "), F.coalesce(text, F.lit("NULL")))
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def mapped_only(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull())


def unmapped(df: DataFrame, value: str, text: str) -> DataFrame:
    """Distinct texts that found no key."""
    return df.where(F.col(value).isNull()).select(text).distinct()
