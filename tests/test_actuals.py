import random
from collections import defaultdict
from decimal import ROUND_HALF_EVEN, Decimal

from conftest import day, rows
from pyspark.sql import functions as F

from planact.operators import actuals

MATERIALS = (("M1", "one", "Cons", "H"), ("M2", "two", "Cons", "N"), ("M3", "three", "Cons", "H"))
MOVES = (
    ("M1", "2025-01-05", "ROH", 55, -12_340),
    ("M2", "2025-01-05", "ROH", 53, -5_000),
    ("M3", "2025-01-05", "ROH", 55, -7_700),
)


def test_totals_and_shares(make):
    """The numerator takes both places, the denominator the main one: shares may pass 100 %."""
    moves, mats = make.movements(*MOVES), make.materials(*MATERIALS)
    assert rows(actuals.daily_total(moves)) == [(day("2025-01-05"), 20)]
    h = actuals.daily_share(moves, mats, actuals.SELECTIONS["concentrates_h"])
    n = actuals.daily_share(moves, mats, actuals.SELECTIONS["concentrates_n"])
    assert rows(h) == [(day("2025-01-05"), 20.0, 100.0)]
    assert rows(n) == [(day("2025-01-05"), 5.0, 25.0)]


def test_days_without_movement_read_zero(make):
    moves, mats = make.movements(*MOVES), make.materials(*MATERIALS)
    assert rows(actuals.daily_total(moves, "2025-01-04", "2025-01-06")) == [
        (day("2025-01-04"), 0), (day("2025-01-05"), 20), (day("2025-01-06"), 0)
    ]
    share = actuals.daily_share(moves, mats, actuals.SELECTIONS["concentrates"], "2025-01-04", "2025-01-05")
    assert rows(share) == [(day("2025-01-04"), 0.0, 0.0), (day("2025-01-05"), 25.0, 125.0)]


def test_summary_rounds_each_movement_first(make):
    moves = make.movements(("M1", "2025-01-05", "ROH", 55, -1_250), ("M1", "2025-01-05", "ROH", 55, -1_350))
    assert rows(actuals.movement_summary(moves, "2025-01-05"), "tons") == [(-2.6,)]
    assert rows(actuals.movement_summary_total(moves), "tons") == [(-2.6,)]


def test_dense_output_covers_every_material_and_day(make):
    moves, mats = make.movements(*MOVES, ("X9", "2025-01-05", "ROH", 55, -9_000)), make.materials(*MATERIALS)
    got = rows(actuals.daily_by_material(moves, mats, actuals.Selection(), "2025-01-05", "2025-01-06"), "day", "material_id", "tons")
    assert len(got) == 6
    assert (day("2025-01-05"), "M1", 12.3) in got and (day("2025-01-06"), "M1", 0.0) in got
    signed = rows(actuals.signed_by_material(moves, mats, "2025-01-05", "2025-01-05"), "material_id", "tons")
    assert signed == [("M1", -12.3), ("M2", 0.0), ("M3", -7.7)]


def test_selection_ignores_case_and_blanks(make):
    moves = make.movements(("A", "2025-01-05", "roh ", 55, -3_000), ("B", "2025-01-05", "ROH", 53, -2_000))
    mats = make.materials(("A", "a", "others", "Ox "), ("B", "b", "Paste", "p"))
    got = rows(actuals.daily_share(moves, mats, actuals.SELECTIONS["other_secondary"]))
    assert got == [(day("2025-01-05"), 5.0, 166.7)]


def _round(x, digits):
    return x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_EVEN)


def _random_case(seed, n=600):
    rng = random.Random(seed)
    kinds = [("Cons", "H"), ("Cons", "N"), ("Cons", "PK"), ("Paste", "P"), ("Others", "Ox"), ("Others", "RI"), ("Others", "RE")]
    mats = [(f"M{i}", f"n{i}", *kinds[i % 7]) for i in range(15)]
    moves = []
    for _ in range(n):
        # one material holds a third of all rows; some are unknown
        m = "M0" if rng.random() < 0.34 else f"M{rng.randrange(18)}"
        moves.append((m, f"2025-01-{rng.randrange(1, 9):02d}", rng.choice(["ROH", "KRSM", "HIBE", "XX"]),
                      rng.choice([51, 53, 55]), -rng.choice([50, 150, 250, 1000, 12340, 99950])))
    return mats, moves


def _by_hand(mats, moves, wanted):
    raw, main = defaultdict(int), defaultdict(int)
    for m, d, c, p, kg in moves:
        if c == "ROH" and p in (53, 55):
            raw[d, m] += kg
        if c == "ROH" and p == 55:
            main[d] += kg
    chosen = {m[0] for m in mats if wanted(m)}
    total = defaultdict(Decimal)
    for (d, m), kg in raw.items():
        if m in chosen:
            total[d] += abs(_round(Decimal(kg) / 1000, 1))
    out = {}
    for d in {d for _, d, c, p, _ in moves if p in (53, 55) and (c in ("ROH", "HIBE") or (c == "KRSM" and p == 55))}:
        whole = _round(abs(Decimal(main[d])) / 1000, 0)
        pct = _round(total[d] * 100 / whole, 1) if whole > 0 else Decimal(0)
        out[day(d)] = (float(total[d]), float(pct))
    return out


def test_shares_equal_brute_force(make):
    cases = {
        "concentrates_h": lambda m: m[2:] == ("Cons", "H"),
        "others": lambda m: m[2] == "Others",
        "other_secondary": lambda m: m[3] in ("Ox", "P"),
        "all_materials": lambda m: True,
    }
    for seed in (1, 2):
        mats, moves = _random_case(seed)
        for name, wanted in cases.items():
            got = actuals.daily_share(make.movements(*moves), make.materials(*mats), actuals.SELECTIONS[name])
            assert {r[0]: r[1:] for r in rows(got)} == _by_hand(mats, moves, wanted)


def test_fused_measures_equal_separate_ones(make):
    mats, moves = _random_case(3)
    m, d = make.movements(*moves), make.materials(*mats)
    span = ("2025-01-01", "2025-01-10")
    fused = actuals.daily_measures(actuals.day_material_mass(m), d, *span)
    for name, selection in actuals.DAILY_SHARES.items():
        one = actuals.daily_share(m, d, selection, *span)
        assert rows(fused, "day", f"{name}_pct") == rows(one, "day", "pct")
    assert rows(fused, "day", "actual") == rows(actuals.daily_total(m, *span))
    assert rows(fused, "day", "fluxes") == rows(actuals.side_stream_daily(m, "flux", *span))
    assert rows(fused, "day", "recirculates") == rows(actuals.side_stream_daily(m, "recirculate", *span))


def test_day_total_is_the_sum_of_its_materials(make):
    mats, moves = _random_case(4)
    m, d = make.movements(*moves), make.materials(*mats)
    dense = actuals.daily_by_material(m, d, actuals.Selection(), "2025-01-01", "2025-01-08")
    summed = dense.groupBy("day").agg(F.sum("tons"))
    total = actuals.daily_share(m, d, actuals.Selection(), "2025-01-01", "2025-01-08")
    assert rows(summed) == rows(total, "day", "tons")
    monthly = actuals.monthly_totals(total)
    assert rows(monthly)[0][0] == "2025-01"
    assert abs(rows(monthly)[0][1] - sum(r[1] for r in rows(total, "day", "tons"))) < 1e-6
