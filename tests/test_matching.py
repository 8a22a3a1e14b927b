import datetime as dt
import random

import pytest
from pyspark.sql import Row

from panelspark.functions import names as N
from panelspark.operators import matching as M
from tests.test_functions import plain_lcs

DAY = dt.date(1990, 1, 1)


def ratio(a, b):
    return 200.0 * plain_lcs(a, b) / (len(a) + len(b))


def tokens(name):
    return {t.strip() for t in name.lower().split(" ")[:3]}


def brute_force(members, patients):
    accepted = []
    for m in members:
        f, l = (x.lower().strip().replace("-", " ") for x in (m["first_name"], m["last_name"]))
        for p in patients:
            pf, pl = p["pat_first_name"].lower().strip(), p["pat_last_name"].lower().strip()
            if m["dob"] != p["birth_date"] or not {f[:1], l[:1]} & {pf[:1], pl[:1]}:
                continue
            match = bool(tokens(m["first_name"]) & tokens(p["pat_first_name"])) and bool(
                tokens(m["last_name"]) & tokens(p["pat_last_name"])
            )
            score = max(ratio(f"{f} {l}", f"{pf} {pl}"), ratio(f"{l} {f}", f"{pf} {pl}"))
            if match or score > 85:
                accepted.append((m["cin"], p["pat_id"], int(match), score))
    return accepted


def people(seed, size, days):
    rng = random.Random(seed)
    firsts = ["mary", "maria", "ann-marie", "Mary Ann", "jo", "john", "jon", "Juan Carlos", "li", "a  b"]
    lasts = ["smith", "smyth", "De La Cruz", "delacruz", "garcia-lopez", "garcia lopez", "ng", "o", "smith jones"]

    def typo(name):
        chars = list(name)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(chars) + 1)
            if rng.random() < 0.5 and len(chars) > 1:
                del chars[min(at, len(chars) - 1)]
            else:
                chars.insert(at, rng.choice("aeilmnrs"))
        return "".join(chars)

    members = [
        {
            "cin": f"{i:010d}", "epic_pat_id": None, "dob": DAY + dt.timedelta(rng.randrange(days)),
            "first_name": typo(rng.choice(firsts)), "last_name": typo(rng.choice(lasts)),
        }
        for i in range(size)
    ]
    patients = []
    for i in range(size):
        first, last = typo(rng.choice(firsts)), typo(rng.choice(lasts))
        if rng.random() < 0.3:
            first, last = last, first
        patients.append(
            {
                "pat_id": f"E{i:05d}", "pat_name": f"{i}", "pat_first_name": first, "pat_last_name": last,
                "birth_date": DAY + dt.timedelta(rng.randrange(days)), "update_date": i, "rec_create_date": i,
            }
        )
    return members, patients


MEMBER = "cin string, epic_pat_id string, dob date, first_name string, last_name string"
PATIENT = (
    "pat_id string, pat_name string, pat_first_name string, pat_last_name string, birth_date date, "
    "update_date int, rec_create_date int"
)


def frames(spark, members, patients):
    return (
        spark.createDataFrame([Row(**m) for m in members], MEMBER),
        spark.createDataFrame([Row(**p) for p in patients], PATIENT),
    )


# Whole blocks by broadcast, whole blocks by salts, token and segment joins, and a mix.
@pytest.mark.parametrize(
    "pairs_per_name, broadcast, per_task, days",
    [(512, 200_000, 250_000, 3), (512, 0, 150, 3), (0, 0, 250_000, 2), (17, 0, 200, 3)],
)
def test_matching_equals_brute_force(spark, monkeypatch, pairs_per_name, broadcast, per_task, days):
    monkeypatch.setattr(M, "BROADCAST_NAMES", broadcast)
    monkeypatch.setattr(M, "PAIRS_PER_TASK", per_task)
    people_ = people(5, 110, days)
    expected = brute_force(*people_)
    members, patients = frames(spark, *people_)
    got = M.accepted_matches(members, patients, pairs_per_name).collect()
    assert sorted((r.cin, r.epic_pat_id, r.name_match, round(r.fuzzy_score, 9)) for r in got) == sorted(
        (c, p, m, round(s, 9)) for c, p, m, s in expected
    )
    best = {}
    for cin, pat_id, _, score in sorted(expected, key=lambda r: (r[0], -r[3], r[1])):
        best.setdefault(cin, (pat_id, score))
    found = M.best_matches(members, patients, pairs_per_name).collect()
    assert len(found) == len(best)
    assert {r.cin: (r.epic_pat_id, r.fuzzy_score) for r in found} == best


def test_hot_block_of_equal_names(spark):
    members = [
        {"cin": f"{i:010d}", "epic_pat_id": None, "dob": DAY, "first_name": "Ann", "last_name": "Lee"}
        for i in range(3000)
    ]
    patients = [
        {
            "pat_id": "E1", "pat_name": "x", "pat_first_name": "ann", "pat_last_name": "lee", "birth_date": DAY,
            "update_date": 1, "rec_create_date": 1,
        }
    ]
    best = M.best_matches(*frames(spark, members, patients))
    assert best.where("epic_pat_id = 'E1' AND fuzzy_score = 100").count() == 3000


def test_current_patients_skip_linked_and_old(spark):
    members = spark.createDataFrame([("a", "E1", DAY, "x", "y"), ("b", None, DAY, "x", "y")], MEMBER)
    rows = [
        ("E1", "n", "f", "l", DAY, 9, 9), ("E2", "n", "f", "l", DAY, 1, 1),
        ("E3", "n", "f", "l", DAY, 2, 1), ("E4", "n", "f", "l", DAY, None, 7),
    ]
    patients = spark.createDataFrame(rows, PATIENT)
    assert [r.pat_id for r in M.current_patients(patients, members).collect()] == ["E3"]


def test_rekey_moves_one_step(spark):
    members = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", None), ("d", "D")], "cin string, epic_pat_id string")
    merges = spark.createDataFrame([("A", "B"), ("B", "C"), ("D", "D")], "old string, new string")
    got = {r.cin: r.epic_pat_id for r in M.rekey_merged(members, merges, "old", "new").collect()}
    assert got == {"a": "B", "b": "C", "c": None, "d": "D"}
    assert sorted(map(tuple, M.merged_ids(members, merges, "old", "new").collect())) == [("B", "a"), ("C", "b")]


def test_enough_grams_stay():
    """Every pair of lengths that may score above 85 shares a gram, and a prefix never passes the name."""
    for n in range(1, 130):
        for m in range(1, 130):
            common = 17 * (n + m) // 40 + 1
            if common > min(n, m):
                continue
            shared = common + (M.Q - 1) * (1 - (n + m - 2 * common))
            assert 1 <= shared <= min(n, m) + M.Q - 1


def test_rare_grams_meet_every_similar_pair_and_few_others(spark):
    rng = random.Random(3)

    def name(size):
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(size))

    members, patients = [], []
    for i in range(10_000):
        first, last = name(rng.randint(3, 9)), name(rng.randint(3, 11))
        members.append({"cin": f"{i:010d}", "epic_pat_id": None, "dob": DAY, "first_name": first, "last_name": last})
        changed = last[:1] + rng.choice("qrst") + last[1:] if i % 2 else last[:-1] + "u"
        patients.append({
            "pat_id": f"E{i}", "pat_name": f"{i}", "pat_first_name": changed if i % 3 else first, "pat_last_name": first if i % 3 else changed,
            "birth_date": DAY, "update_date": 1, "rec_create_date": 1,
        })
    m, p = frames(spark, members, patients)
    m_names = M._with_member_columns(M._member_names(m))
    p_names = M._with_patient_columns(M._patient_names(p))
    found = M.similar_candidates(m_names, p_names).select("m_first", "m_last", "pat_id")
    assert found.count() < 10_000 * 10_000 / 1000
    got = {(r.m_first, r.m_last, r.pat_id) for r in found.collect()}
    for i, (a, b) in enumerate(zip(members, patients, strict=True)):
        names = f"{a['first_name']} {a['last_name']}", f"{a['last_name']} {a['first_name']}"
        if max(ratio(x, f"{b['pat_first_name']} {b['pat_last_name']}") for x in names) > 85:
            assert (a["first_name"], a["last_name"], f"E{i}") in got


def test_chunks_give_each_similar_pair_once_and_no_other(spark, monkeypatch):
    """Names of few words share most of their letters and often both initials."""
    monkeypatch.setattr(M, "CHUNK", 7)
    rng = random.Random(5)
    words = ["hot", "old", "large", "green", "ring", "anvil", "gear", "", "Ödön", "hot-ring", "g" * 70]
    people = [(rng.choice(words), rng.choice(words)) for _ in range(60)]
    members = [{"cin": f"{i}", "epic_pat_id": None, "dob": DAY, "first_name": a, "last_name": b} for i, (a, b) in enumerate(sorted(set(people)))]
    patients = [
        {"pat_id": f"E{i}", "pat_name": f"{i}", "pat_first_name": b[1:], "pat_last_name": a, "birth_date": DAY, "update_date": 1, "rec_create_date": 1}
        for i, (a, b) in enumerate(sorted(set(people)))
    ]
    m, p = frames(spark, members, patients)
    m_names = M._with_member_columns(M._member_names(m))
    p_names = M._with_patient_columns(M._patient_names(p))
    found = M.similar_candidates(m_names, p_names).select("m_first", "m_last", "pat_id")
    got = [tuple(r) for r in found.collect() if max(map(len, r)) < 60]
    expected = set()
    for a in members:
        first, last = (a[c].lower().replace("-", " ") for c in ("first_name", "last_name"))
        for b in patients:
            other = b["pat_first_name"].lower(), b["pat_last_name"].lower()
            initials = {first[:1], last[:1]} & {other[0][:1], other[1][:1]}
            if initials and max(ratio(x, " ".join(other)) for x in (f"{first} {last}", f"{last} {first}")) > 85:
                expected.add((a["first_name"].lower(), a["last_name"].lower(), b["pat_id"]))
    long = {f"E{i}" for i, b in enumerate(patients) if len(b["pat_first_name"]) + len(b["pat_last_name"]) > 60}
    assert sorted(x for x in got if x[2] not in long) == sorted(x for x in expected if x[2] not in long and max(map(len, x)) < 60)
    assert {x for x in expected if x[2] in long} <= {tuple(r) for r in found.collect()}


@pytest.mark.parametrize("largest, chunks", [(1000, 3), (12, 10)])
def test_rows_repeat_for_few_chunks(spark, monkeypatch, largest, chunks):
    """A block of many names is dealt into CHUNKS parts until they reach their largest size; names of a part meet in tiles."""
    for name, value in [("CHUNK", 2), ("CHUNKS", 3), ("LARGEST_CHUNK", largest), ("ROWS", 2), ("COLUMNS", 5)]:
        monkeypatch.setattr(M, name, value)
    seen, write = {}, M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name: seen.setdefault(name, write(df, name)))
    rng = random.Random(8)
    names = sorted({("a" + "".join(rng.choices("lnor", k=rng.randint(4, 8))), "".join(rng.choices("aest", k=rng.randint(4, 9)))) for _ in range(110)})
    members = [{"cin": f"{i}", "epic_pat_id": None, "dob": DAY, "first_name": a, "last_name": b} for i, (a, b) in enumerate(names)]
    patients = [
        {"pat_id": f"E{i}", "pat_name": f"{i}", "pat_first_name": a if i % 2 else b, "pat_last_name": b[1:] if i % 2 else a + "x", "birth_date": DAY,
         "update_date": 1, "rec_create_date": 1}
        for i, (a, b) in enumerate(names)
    ]
    m, p = frames(spark, members, patients)
    found = M.similar_candidates(M._with_member_columns(M._member_names(m)), M._with_patient_columns(M._patient_names(p)))
    got = sorted((r.m_first, r.m_last, r.pat_id) for r in found.collect())
    of_a = seen["chunks"].where("initial = 'a'").first()
    assert (of_a.m_chunks, of_a.p_chunks) == (chunks, chunks)
    assert got == sorted(
        (*x, f"E{i}") for x in names for i, b in enumerate(patients)
        if {x[0][:1], x[1][:1]} & {b["pat_first_name"][:1], b["pat_last_name"][:1]}
        and max(ratio(" ".join(y), f"{b['pat_first_name']} {b['pat_last_name']}") for y in (x, x[::-1])) > 85
    )


def test_an_edit_changes_three_grams_at_most():
    rng = random.Random(2)
    for _ in range(2000):
        text = changed = "".join(rng.choices("abc é", k=rng.randint(1, 40)))
        edits = rng.randint(0, 6)
        for _ in range(edits):
            at = rng.randint(0, len(changed))
            changed = changed[:at] + rng.choice("abcdé") + changed[at:] if rng.random() < 0.5 or not changed else changed[: max(at - 1, 0)] + changed[max(at, 1) :]
        one, other = (N.gram_bits(N.name_codes([x], f), f)[0] for x, f in zip((text, changed), N.FILLERS, strict=True))
        assert int(one ^ other).bit_count() <= 3 * edits
