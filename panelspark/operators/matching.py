"""Identity matching of members with external patients.

A patient may be a member's match if both share the date of birth and an initial of first
or last name, and if either a first-name and a last-name token agree or the name similarity
exceeds 85. The best patient per member wins.

Members and patients are reduced to distinct names per date of birth, and pairs of names are
found by equality joins:

* Names that agree in a token meet on their tokens.
* Similar names of a block (one date of birth) whose pairs stay within a fixed number per name are
  joined whole, spread over as many salts as it needs.
* Those of a larger block are dealt by initial into chunks of bounded size, and every chunk of members
  meets every chunk of patients. A pair costs a few machine words there: the letters and lengths of
  two names that score above 85 differ by their edits at most.

All ways feed the same exact test, and none drops a pair that passes it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import names as N
from panelspark.operators.keys import not_in
from panelspark.operators.latest import first_per_group, latest_version
from panelspark.session import materialize

PAIRS_PER_NAME = 512
PAIRS_PER_TASK = 250_000
MAX_TASKS = 100_000
BROADCAST_NAMES = 100_000

#: Names of a chunk, in large blocks: from the least on average, in a few chunks of any size, to the most.
CHUNK = 2048
CHUNKS = 4
LARGEST_CHUNK = 1 << 17

#: Names of either side whose letters are compared at once, so that they stay in the cache.
ROWS, COLUMNS = 64, 2048

LARGE_PAIRS_PER_TASK = 100_000_000
MAX_LARGE_TASKS = 2_000

#: Tasks that score the found pairs, at most.
SCORE_TASKS = 200

#: Characters of a gram. No join uses grams any more; a test of their bound reads it.
Q = 3

MEMBER_KEY = ["m_first", "m_last"]
PATIENT_KEY = ["p_first", "p_last", "pat_id"]


def current_patients(patients: DataFrame, membership: DataFrame) -> DataFrame:
    """The newest row per name and birth date of the patients not yet linked."""
    linked = membership.select(F.col("epic_pat_id").alias("pat_id"))
    return latest_version(
        not_in(patients, linked, ["pat_id"]),
        ["pat_name", "birth_date"],
        ["update_date", "rec_create_date"],
        "pat_id",
    )


def _member_names(membership: DataFrame) -> DataFrame:
    return membership.where(F.col("epic_pat_id").isNull() & F.col("dob").isNotNull()).select(
        "cin",
        "dob",
        F.lower("first_name").alias("m_first"),
        F.lower("last_name").alias("m_last"),
    )


def _patient_names(patients: DataFrame) -> DataFrame:
    return patients.where(F.col("birth_date").isNotNull()).select(
        "pat_id",
        F.col("birth_date").cast("date").alias("dob"),
        F.lower("pat_first_name").alias("p_first"),
        F.lower("pat_last_name").alias("p_last"),
    )


def _member_columns() -> dict[str, Column]:
    """What the test of a pair needs from the member's name."""
    raw_first, raw_last = F.col("m_first"), F.col("m_last")
    first, last = N.normal_name(raw_first), N.normal_name(raw_last)
    return {
        "phc_name": N.full_name(first, last),
        "phc_name_flipped": N.full_name(last, first),
        "m_initial_1": F.left(first, F.lit(1)),
        "m_initial_2": F.left(last, F.lit(1)),
        "m_tokens_first": N.name_tokens(raw_first),
        "m_tokens_last": N.name_tokens(raw_last),
        "m_length": F.length(N.full_name(first, last)),
    }


def _patient_columns() -> dict[str, Column]:
    """What the test of a pair needs from the patient's name."""
    raw_first, raw_last = F.col("p_first"), F.col("p_last")
    first, last = N.normal_name(raw_first, hyphens=False), N.normal_name(raw_last, hyphens=False)
    return {
        "epic_name": N.full_name(first, last),
        "p_initial_1": F.left(first, F.lit(1)),
        "p_initial_2": F.left(last, F.lit(1)),
        "p_tokens_first": N.name_tokens(raw_first),
        "p_tokens_last": N.name_tokens(raw_last),
        "p_length": F.length(N.full_name(first, last)),
    }


def _with_member_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(_member_columns()).withColumn("m_letters", N.letter_signature("phc_name"))


def _with_patient_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(_patient_columns()).withColumn("p_letters", N.letter_signature("epic_name"))


def _same_initial() -> Column:
    same = F.lit(False)
    for mine in ("m_initial_1", "m_initial_2"):
        for other in ("p_initial_1", "p_initial_2"):
            same = same | F.coalesce(F.col(mine) == F.col(other), F.lit(False))
    return same


def _letters_allow() -> Column:
    return N.letters_allow("m_letters", "p_letters", "m_length", "p_length")


def _block_pairs(members: DataFrame, patients: DataFrame, blocks: DataFrame, tasks: int) -> DataFrame:
    """All pairs of the given blocks; a block is spread over salts of bounded size.

    The larger side of a block is split and the smaller one repeated. Blocks are limited in
    pairs per name, so the repeated rows stay in proportion to the names.
    """
    salted = blocks.withColumn("salts", F.expr(f"CAST(ceil(n_members * n_patients / {PAIRS_PER_TASK}) AS INT)"))
    every = "sequence(0, salts - 1)"

    def salt(split_side: str, name: str) -> Column:
        one = f"array(CAST(pmod(xxhash64({name}), salts) AS INT))"
        return F.explode(F.expr(f"IF({split_side}, {one}, {every})"))

    sizes = ["n_members", "n_patients", "salts"]
    left = members.join(salted, "dob").withColumn("salt", salt("n_members >= n_patients", "m_id"))
    right = patients.join(salted, "dob").withColumn("salt", salt("n_members < n_patients", "p_id"))
    return left.drop(*sizes).repartition(tasks, "dob", "salt").join(right.drop(*sizes), ["dob", "salt"])


def _token_pairs(members: DataFrame, patients: DataFrame) -> DataFrame:
    """Pairs that share a first-name and a last-name token, and an initial."""
    left = members.withColumn("t_first", F.explode("m_tokens_first")).withColumn(
        "t_last", F.explode("m_tokens_last")
    )
    right = patients.withColumn("t_first", F.explode("p_tokens_first")).withColumn(
        "t_last", F.explode("p_tokens_last")
    )
    key = ["dob", "t_first", "t_last"]
    left = left.select(*key, "m_id", "m_initial_1", "m_initial_2")
    right = right.select(*key, "p_id", "p_initial_1", "p_initial_2")
    return left.join(right, key).where(_same_initial()).select("m_id", "p_id")


def _by_initial(names: DataFrame, side: str) -> DataFrame:
    """A row for each distinct initial of a name; ``x_code`` stands for it and ``x_other`` for the name's other one."""

    def code(initial: str) -> str:
        return f"IF({initial} = '', -1, ascii({initial}))"

    none = -2 if side == "m" else -3
    initials = f"array_distinct(filter(array({side}_initial_1, {side}_initial_2), x -> x IS NOT NULL))"
    return (
        names.withColumn("_initials", F.expr(initials))
        .withColumn("initial", F.explode("_initials"))
        .withColumns({
            f"{side}_code": F.expr(code("initial")),
            f"{side}_other": F.expr(f"coalesce(get(transform(filter(_initials, x -> x <> initial), x -> {code('x')}), 0), {none})"),
        })
        .drop("_initials")
    )


def _chunk_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Rows of both tables that score above 85, straight or flipped, or are too long to tell.

    Letters and lengths come first, then pairs of letters: an edit changes three of these at most. A pair of names that shares
    two initials comes from the chunks of the smaller one only. What is kept between are the pairs found, however large the chunks are.
    """
    letters, others = left["m_letters"].to_numpy().view("u8"), right["p_letters"].to_numpy().view("u8")
    lengths, sizes = left["m_length"].to_numpy(), right["p_length"].to_numpy()
    m_other, p_other = left["m_other"].to_numpy(), right["p_other"].to_numpy()
    orders = [N.name_codes(left[c].to_pylist(), N.FILLERS[0]) for c in ("phc_name", "phc_name_flipped")]
    texts = N.name_codes(right["epic_name"].to_pylist(), N.FILLERS[1])
    grams, of_text = [N.gram_bits(codes, N.FILLERS[0]) for codes in orders], N.gram_bits(texts, N.FILLERS[1])
    code = left["m_code"][0].as_py()
    mine, theirs = [np.empty(0, "i8")], [np.empty(0, "i8")]
    for n in np.unique(lengths):
        edits = n + sizes - 2 * (17 * (n + sizes) // 40 + 1)
        near = np.flatnonzero(edits >= np.abs(n - sizes))
        rows = np.flatnonzero(lengths == n)
        for some_near in np.array_split(near, len(near) // COLUMNS + 1):
            most, near_letters = np.minimum(edits[some_near], 64).astype("u1"), others[some_near]
            found = []
            for at in range(0, len(rows), ROWS) if some_near.size else ():
                alike = np.bitwise_count(letters[rows[at : at + ROWS], None] ^ near_letters) <= most
                found.append(np.flatnonzero(alike) + at * len(some_near))
            if not found:
                continue
            i, j = np.divmod(np.concatenate(found), len(some_near))
            i, j = rows[i], some_near[j]
            first = (m_other[i] != p_other[j]) | (m_other[i] > code)
            i, j = i[first], j[first]
            n_edits, similar = edits[j], np.maximum(n, sizes[j]) > N.SHORT
            alike = [~similar & (np.bitwise_count(x[i] ^ of_text[j]) <= 3 * n_edits) for x in grams]
            for codes, ones in zip(orders, alike, strict=True):
                for part in np.array_split(np.flatnonzero(ones), np.count_nonzero(ones) // 8192 + 1):
                    similar[part] |= N.lcs_of_codes(codes[i[part]], texts[j[part]]) > 17 * (n + sizes[j[part]]) // 40
            mine.append(i[similar])
            theirs.append(j[similar])
    a, b = left.take(pa.array(np.concatenate(mine))), right.take(pa.array(np.concatenate(theirs)))
    columns = {c: a[c] for c in left.column_names if c not in _PAIRED} | {c: b[c] for c in right.column_names if c not in [*_PAIRED, "dob"]}
    return pa.table(columns)


#: Columns that only the pairing of chunks needs.
_PAIRED = [
    "initial", "m_chunk", "p_chunk", "m_code", "p_code", "m_other", "p_other", "m_letters", "p_letters", "m_length", "p_length",
    "phc_name", "phc_name_flipped", "epic_name",
]


def similar_candidates(
    members: DataFrame,
    patients: DataFrame,
    tasks: int = 8,
    member_key: list[str] = MEMBER_KEY,
    patient_key: list[str] = PATIENT_KEY,
) -> DataFrame:
    """Pairs of names, straight or flipped, that score above 85 or are too long to tell here. None that does is missing.

    Names meet by date of birth and initial, in chunks. A row repeats once for each chunk of the other side: CHUNKS
    times, until chunks reach their largest size. No task holds more than two chunks, however large a block is.
    """
    left = _by_initial(members.select("dob", *member_key, "phc_name", "phc_name_flipped", "m_letters", "m_length", "m_initial_1", "m_initial_2"), "m")
    right = _by_initial(patients.select("dob", *patient_key, "epic_name", "p_letters", "p_length", "p_initial_1", "p_initial_2"), "p")
    key = ["dob", "initial"]
    number = F.expr(f"CAST(greatest(least(ceil(count(*) / {CHUNK}), {CHUNKS}), ceil(count(*) / {LARGEST_CHUNK})) AS INT)")
    chunks = left.groupBy(*key).agg(number.alias("m_chunks")).join(right.groupBy(*key).agg(number.alias("p_chunks")), key)
    chunks = materialize(chunks, "chunks")
    met = chunks.agg(F.sum(F.col("m_chunks").cast("long") * F.col("p_chunks"))).first()[0] or 1
    tasks = min(tasks, 2 * met)

    def dealt(names: DataFrame, side: str, name: list[str]) -> DataFrame:
        own = F.expr(f"CAST(pmod(xxhash64({', '.join(name)}), {side}_chunks) AS INT)")
        other = "p" if side == "m" else "m"
        return (
            names.drop(f"{side}_initial_1", f"{side}_initial_2").join(chunks, key)
            .withColumns({f"{side}_chunk": own, f"{other}_chunk": F.explode(F.expr(f"sequence(0, {other}_chunks - 1)"))})
            .drop("m_chunks", "p_chunks")
            .repartition(tasks, *key, "m_chunk", "p_chunk")
            .groupBy(*key, "m_chunk", "p_chunk")
        )

    fields = {f.name: f for f in [*left.schema, *right.schema]}
    schema = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in ["dob", *member_key, *patient_key])
    return dealt(left, "m", member_key).cogroup(dealt(right, "p", patient_key)).applyInArrow(_chunk_pairs, schema)


def accepted_names(
    members: DataFrame, patients: DataFrame, pairs_per_name: int = PAIRS_PER_NAME
) -> DataFrame:
    """Accepted pairs of distinct names with score and match flag; a pair may repeat."""
    m_names = _with_member_columns(members.select("dob", *MEMBER_KEY).distinct())
    m_names = materialize(m_names.withColumn("m_id", F.monotonically_increasing_id()), "member-names")
    p_names = patients.groupBy("dob", "p_first", "p_last").agg(F.min("pat_id").alias("pat_id"))
    p_names = _with_patient_columns(p_names)
    p_names = materialize(p_names.withColumn("p_id", F.monotonically_increasing_id()), "patient-names")
    blocks = (
        m_names.groupBy("dob").agg(F.count("*").alias("n_members"))
        .join(p_names.groupBy("dob").agg(F.count("*").alias("n_patients")), "dob")
        .withColumn("whole", F.expr(f"n_members * n_patients <= {pairs_per_name} * (n_members + n_patients)"))
    )
    totals = blocks.selectExpr(
        "coalesce(sum(IF(whole, n_members * n_patients, 0)), 0) AS pairs",
        "coalesce(sum(IF(whole, 0, CAST(n_members * n_patients AS DOUBLE))), 0) AS large_pairs",
        "coalesce(sum(n_patients), 0) AS patients",
        "count_if(NOT whole) AS large",
    ).first()
    tasks = min(MAX_TASKS, totals.pairs // PAIRS_PER_TASK + 1)
    large_tasks = int(min(MAX_LARGE_TASKS, totals.large_pairs // LARGE_PAIRS_PER_TASK + 1))
    names = m_names.select("dob", "m_id", "m_letters", "m_length", "m_initial_1", "m_initial_2")
    others = p_names.select("dob", "p_id", "p_letters", "p_length", "p_initial_1", "p_initial_2")
    few = totals.patients <= BROADCAST_NAMES
    if totals.large == 0 and few:
        pairs = names.repartition(tasks, "dob", "m_id").join(F.broadcast(others), "dob")
    else:
        pairs = _block_pairs(names, others, blocks.where("whole").drop("whole"), tasks)
    found = pairs.where(_letters_allow() & _same_initial()).select("m_id", "p_id").unionByName(_token_pairs(m_names, p_names))
    if totals.large > 0:
        in_large = blocks.where("NOT whole").select("dob")
        similar = similar_candidates(m_names.join(in_large, "dob"), p_names.join(in_large, "dob"), large_tasks, ["m_id"], ["p_id"])
        found = found.unionByName(similar.select("m_id", "p_id"))
    spread = found.repartition(min(SCORE_TASKS, max(large_tasks, tasks)), "m_id").distinct()
    return _accept(spread.join(m_names, "m_id").join((F.broadcast(p_names) if few else p_names).drop("dob"), "p_id"))


def _accept(pairs: DataFrame) -> DataFrame:
    """Initial filter, token match and exact score.

    Cheap tests come first; a flipped name has the same letters. The generator keeps the score from
    being computed again in the filter behind it.
    """
    same_tokens = F.coalesce(
        F.arrays_overlap("m_tokens_first", "p_tokens_first") & F.arrays_overlap("m_tokens_last", "p_tokens_last"),
        F.lit(False),
    )
    straight, flipped, name = "phc_name", "phc_name_flipped", "epic_name"
    tested = pairs.where(_same_initial() & (same_tokens | _letters_allow())).select(
        "dob", *MEMBER_KEY, *PATIENT_KEY, straight, flipped, name, same_tokens.cast("int").alias("name_match")
    )
    scored = tested.withColumns({f"_{x}": N.similarity(x, name, batched=True) for x in (straight, flipped)})
    return scored.select(
        "dob", *MEMBER_KEY, *PATIENT_KEY, straight, name, "name_match",
        F.explode(F.array(F.greatest(f"_{straight}", f"_{flipped}"))).alias("fuzzy_score"),
    ).where((F.col("name_match") == 1) | (F.col("fuzzy_score") > 85))


def accepted_matches(
    membership: DataFrame, patients: DataFrame, pairs_per_name: int = PAIRS_PER_NAME
) -> DataFrame:
    """Every accepted pair of a member and a current patient."""
    members, patients = _member_names(membership), _patient_names(patients)
    pairs = accepted_names(members, patients, pairs_per_name).drop("pat_id").distinct()
    m, p = members.alias("m"), patients.alias("p")
    with_members = pairs.alias("x").join(m, _same_name("x", "m", "m_first", "m_last")).select("x.*", "m.cin")
    return (
        with_members.alias("x")
        .join(p, _same_name("x", "p", "p_first", "p_last"))
        .select("cin", F.col("p.pat_id").alias("epic_pat_id"), "x.dob", "phc_name", "epic_name", "name_match", "fuzzy_score")
    )


def best_matches(
    membership: DataFrame, patients: DataFrame, pairs_per_name: int = PAIRS_PER_NAME
) -> DataFrame:
    """The highest-scoring accepted patient per member, ties by lowest patient id."""
    members = _member_names(membership)
    pairs = accepted_names(members, _patient_names(patients), pairs_per_name)
    best = first_per_group(
        pairs, ["dob", "m_first", "m_last"], [F.desc("fuzzy_score"), F.asc("pat_id")]
    )
    return (
        members.alias("m")
        .join(best.alias("x"), _same_name("m", "x", "m_first", "m_last"))
        .select("cin", F.col("pat_id").alias("epic_pat_id"), "m.dob", "phc_name", "epic_name", "name_match", "fuzzy_score")
    )


def _same_name(a: str, b: str, first: str, last: str) -> Column:
    return (
        (F.col(f"{a}.dob") == F.col(f"{b}.dob"))
        & F.col(f"{a}.{first}").eqNullSafe(F.col(f"{b}.{first}"))
        & F.col(f"{a}.{last}").eqNullSafe(F.col(f"{b}.{last}"))
    )


def matching_log(best: DataFrame) -> DataFrame:
    return best.select("epic_pat_id", "cin", "dob", "phc_name", "epic_name", "fuzzy_score")


def apply_links(membership: DataFrame, best: DataFrame) -> DataFrame:
    """Write the accepted patient ids to the membership."""
    links = best.select("cin", F.col("epic_pat_id").alias("_linked"))
    return (
        membership.join(links, "cin", "left")
        .withColumn("epic_pat_id", F.coalesce("_linked", "epic_pat_id"))
        .drop("_linked")
    )


def merged_ids(membership: DataFrame, merges: DataFrame, old: str, new: str) -> DataFrame:
    """Members whose external id was merged into another, with the id one step further."""
    steps = (
        merges.where(F.col(old) != F.col(new))
        .groupBy(F.col(old).alias("epic_pat_id"))
        .agg(F.min(new).alias("new_id"))
    )
    linked = membership.select("cin", "epic_pat_id").where(F.col("epic_pat_id").isNotNull())
    return linked.join(steps, "epic_pat_id").select(F.col("new_id").alias("epic_pat_id"), "cin")


def rekey_merged(membership: DataFrame, merges: DataFrame, old: str, new: str) -> DataFrame:
    return apply_links(membership, merged_ids(membership, merges, old, new))
