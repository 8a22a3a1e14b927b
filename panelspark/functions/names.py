"""Person names: normal forms, tokens and similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# A longest-common-subsequence row fits one bigint up to this length.
SHORT = 62


def normal_name(name: Column, hyphens: bool = True) -> Column:
    """Trimmed lower case. With ``hyphens`` (member names) a hyphen becomes a blank."""
    lowered = F.trim(F.lower(name))
    return F.replace(lowered, F.lit("-"), F.lit(" ")) if hyphens else lowered


def name_token(name: Column, index: int) -> Column:
    """Blank-separated token ``index`` of the raw name; two blanks enclose an empty one."""
    return F.trim(F.lower(F.get(F.split(name, " ", -1), F.lit(index))))


def name_tokens(name: Column) -> Column:
    """The first three tokens, without repeats; none for a missing name."""
    tokens = F.slice(F.split(F.lower(name), " ", -1), 1, 3)
    return F.array_distinct(F.transform(tokens, F.trim))


def full_name(first: Column, last: Column) -> Column:
    """Both parts around one blank; a missing part counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def lcs_length(a: str, b: str) -> Column:
    """Length of the longest common subsequence of two text columns.

    Up to 62 characters a row of the table is one bigint, and a character costs one addition
    and two masks. The addition carries towards later characters, hence the reversed letters.
    Longer pairs go row by row. The one-element arrays name values used more than once.
    """

    def bits(pattern: str, text: str) -> str:
        return f"""
          length({pattern}) - bit_count(get(transform(
            array(struct(split(reverse({pattern}), '') AS letters,
                         shiftleft(1L, length({pattern})) - 1L AS full)),
            p -> aggregate(split({text}, ''), p.full, (row, ch) -> get(transform(
              array(row & aggregate(p.letters, 0L, (mask, x) -> mask * 2L + CAST(x = ch AS BIGINT))),
              hit -> ((row + hit) | (row - hit)) & p.full), 0))), 0))"""

    def rows(pattern: str, text: str) -> str:
        return f"""
          get(transform(array(split({pattern}, '')), letters -> element_at(
            aggregate(split({text}, ''), array_repeat(0, size(letters) + 1), (row, ch) ->
              aggregate(sequence(1, size(letters)), array(0), (done, j) -> concat(done, array(greatest(
                element_at(done, -1), get(row, j),
                get(row, j - 1) + CAST(get(letters, j - 1) = ch AS INT)))))), -1)), 0)"""

    return F.expr(
        f"""CAST(CASE WHEN {a} = '' OR {b} = '' THEN 0
                      WHEN length({a}) <= {SHORT} THEN {bits(a, b)}
                      WHEN length({b}) <= {SHORT} THEN {bits(b, a)}
                      ELSE {rows(a, b)} END AS INT)"""
    )


def letter_masks(name: str) -> Column:
    """Positions of each letter of a text column as bits, NULL beyond 62 characters."""
    return F.expr(
        f"""CASE WHEN length({name}) <= {SHORT} THEN get(transform(
              array(struct(split(reverse({name}), '') AS letters, array_distinct(split({name}, '')) AS kinds)),
              t -> map_from_arrays(t.kinds, transform(t.kinds, kind ->
                aggregate(t.letters, 0L, (mask, x) -> mask * 2L + CAST(x = kind AS BIGINT))))), 0) END"""
    )


def lcs_length_masked(text: str, name: str, masks: str) -> Column:
    """``lcs_length`` of a text with a name whose letter masks were computed before."""
    full = f"(shiftleft(1L, length({name})) - 1L)"
    bits = f"""length({name}) - bit_count(aggregate(
        transform(split({text}, ''), ch -> coalesce(element_at({masks}, ch), 0L)), {full},
        (row, mask) -> ((row + (row & mask)) | (row & ~mask)) & {full}))"""
    return (
        F.when((F.col(text) == "") | (F.col(name) == ""), 0)
        .when(F.col(masks).isNotNull(), F.expr(bits).cast("int"))
        .otherwise(lcs_length(text, name))
    )


def name_codes(names: list[str | None], filler: int) -> np.ndarray:
    """Code points of the names as rows of one length; ``filler`` is no code point. Names beyond 62 characters, and missing ones, give none."""
    short = ["" if name is None or len(name) > SHORT else name for name in names]
    codes = np.full((len(short), max(map(len, short), default=0)), filler, "u4")
    for row, name in zip(codes, short, strict=True):
        row[: len(name)] = np.frombuffer(name.encode("utf-32-le"), "u4")
    return codes


def gram_bits(codes: np.ndarray, filler: int) -> np.ndarray:
    """The pairs of neighbouring letters of each row of codes, as hashed bits of one word.

    An insertion or deletion changes three pairs at most, so two texts differ in three bits for each edit at most.
    """
    bits, one = np.zeros(len(codes), "u8"), np.uint64(1)
    for a, b in zip(codes.T[:-1], codes.T[1:], strict=True):
        at = (a.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(58)
        bits |= np.where(b == filler, np.uint64(0), one << at)
    return bits


def lcs_of_codes(patterns: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """``lcs_length`` row by row, for codes with different fillers: a row of the table is one word for each pair."""
    rows, hits = np.full(len(patterns), 2**64 - 1, "u8"), np.zeros((len(patterns), 8), "u1")
    for letter in texts.T:
        bits = np.packbits(patterns == letter[:, None], axis=1, bitorder="little")
        hits[:, : bits.shape[1]] = bits
        mask = hits.view("<u8")[:, 0]
        rows = (rows + (rows & mask)) | (rows & ~mask)
    return np.bitwise_count(~rows)


#: No code points: what fills up a member's name and a patient's.
FILLERS = 2**32 - 1, 2**32 - 2


@F.pandas_udf(IntegerType())
def _lcs_of_short(a: pd.Series, b: pd.Series) -> pd.Series:
    codes = (name_codes(names.tolist(), filler) for names, filler in zip((a, b), FILLERS, strict=True))
    return pd.Series(lcs_of_codes(*codes).astype("i4"))


def lcs_length_batched(a: str, b: str) -> Column:
    """``lcs_length``, of whole batches of names at once up to 62 characters."""
    short = (F.length(a) <= SHORT) & (F.length(b) <= SHORT)
    return F.when(short, _lcs_of_short(F.when(short, F.col(a)), F.when(short, F.col(b)))).otherwise(lcs_length(a, b))


def min_common(len_a: Column, len_b: Column) -> Column:
    """The least common-subsequence length that scores above 85."""
    return F.floor(17 * (len_a + len_b) / 40).cast("int") + 1


def max_edits(len_a: Column, len_b: Column) -> Column:
    """The most insertions and deletions a pair may need and still score above 85.

    The score is ``200 * lcs / (len_a + len_b)`` and the edits are
    ``len_a + len_b - 2 * lcs``, so ``lcs`` must exceed ``17 * (len_a + len_b) / 40``.
    """
    return len_a + len_b - 2 * min_common(len_a, len_b)


def letter_signature(name: str) -> Column:
    """Counts of the letters of a text column, as thermometer codes in one bigint.

    Letters fall into 21 classes of three bits for "at least one, two, three". Two signatures
    differ in no more bits than one text needs insertions and deletions to become the other.
    """
    return F.expr(
        f"""aggregate(
              transform(split({name}, ''), ch -> CAST(3 * pmod(ascii(ch), 21) AS INT)), 0L, (bits, at) ->
              bits | (shiftleft(bits & shiftleft(7L, at), 1) & shiftleft(7L, at)) | shiftleft(1L, at))"""
    )


def edit_bound(len_a: str, len_b: str) -> str:
    """SQL text of ``max_edits`` for two length columns."""
    total = f"({len_a} + {len_b})"
    return f"({total} - 2 * (CAST(floor(17 * {total} / 40) AS INT) + 1))"


def letters_allow(signature_a: str, signature_b: str, len_a: str, len_b: str) -> Column:
    """First test that no pair scoring above 85 fails, on signatures and lengths alone."""
    return F.expr(f"bit_count({signature_a} ^ {signature_b}) <= {edit_bound(len_a, len_b)}")


def may_exceed_85(a: str, b: str, len_a: str | None = None, len_b: str | None = None) -> Column:
    """Second test that no pair of text columns scoring above 85 fails.

    The edit distance with substitutions never exceeds the one without, and the built-in
    function stops as soon as it passes the bound.
    """
    edits = edit_bound(len_a or f"length({a})", len_b or f"length({b})")
    return F.expr(f"{edits} >= 0 AND levenshtein({a}, {b}, greatest({edits}, 0)) >= 0")


def similarity(a: str, b: str, masks_b: str | None = None, batched: bool = False) -> Column:
    """Normalized insert/delete similarity of two text columns, 0 to 100."""
    common = lcs_length_masked(a, b, masks_b) if masks_b else lcs_length_batched(a, b) if batched else lcs_length(a, b)
    return F.lit(200.0) * common / (F.length(a) + F.length(b))
