"""Feature tables against a row-by-row calculation in plain Python."""

import math
import random
from datetime import datetime, timedelta

import pytest
from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from lealtia.operators import features as fe
from lealtia.operators.anchor import last_transaction, with_anchor
from lealtia.plans import customer_features as cf
from lealtia.sources.readers import customers, transactions
from lealtia.sources.schemas import CUSTOMERS, TRANSACTIONS

CATEGORIES = ["COMIDAS", "DEPORTE", "TECNOLOGIA", "HOGAR", None]


def make_rows(seed=7):
    rng = random.Random(seed)
    rows = []
    for k in range(900):
        # One customer holds a third of all rows.
        customer = 1 if k % 3 == 0 else rng.randint(2, 40)
        moment = datetime(2022, 1, 31, 12) + timedelta(hours=rng.randint(0, 24 * 900))
        rows.append(
            (
                k if k % 50 else None,
                customer if k % 97 else None,
                moment.strftime("%Y-%m-%d %H:%M:%S") if k % 41 else "not a date",
                rng.choice(CATEGORIES),
                rng.choice(["Sale", "Redemption"]),
                round(rng.uniform(-50, 300), 2) if k % 31 else None,
                float(rng.randint(-20, 60)),
            )
        )
    rows.append((9001, 77, "not a date", "TECNOLOGIA", "Sale", 10.0, 1.0))
    rows.append((9002, 78, "2024-05-31 00:00:00", "TECNOLOGIA", "Sale", 10.0, 1.0))
    rows.append((9003, 78, "2024-02-29 00:00:00", "TECNOLOGIA", "Sale", 20.0, 2.0))
    rows.append((9004, 78, "2024-02-28 00:00:00", "TECNOLOGIA", "Sale", 40.0, 4.0))
    return rows


def make_customers():
    people = [(i, "Cali", "F", i % 6, 10.5 * i, f"{1950 + i}-03-01") for i in range(1, 38)]
    return [*people, (78, "Cali", "M", None, None, "bad"), (500, None, None, 3, 7.0, "1990-01-01")]


@pytest.fixture(scope="module")
def tables(spark):
    tx = transactions(spark.createDataFrame(make_rows(), TRANSACTIONS)).repartition(4)
    cust = customers(spark.createDataFrame(make_customers(), CUSTOMERS))
    return tx, cust


def parse(text):
    try:
        return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


def by_customer():
    grouped = {}
    for ident, customer, moment, category, kind, value, points in make_rows():
        if customer is not None:
            grouped.setdefault(customer, []).append((ident, parse(moment), category, kind, value, points))
    return grouped


def measures(rows):
    return {
        "num_tx": sum(r[0] is not None for r in rows),
        "gasto": sum(r[4] or 0 for r in rows),
        "puntos_ganados": sum(max(r[5], 0) for r in rows),
        "puntos_redimidos": sum(max(-r[5], 0) for r in rows),
    }


def expected(rows):
    dates = [r[1] for r in rows if r[1]]
    last = max(dates) if dates else None

    def inside(start, end=None):
        if last is None:
            return []
        low = last - relativedelta(months=start)
        high = None if end is None else last - relativedelta(months=end)
        return [r for r in rows if r[1] and r[1] >= low and (high is None or r[1] < high)]

    out = {"last_date": last}
    out |= {f"{k}_total": v for k, v in measures(rows).items()}
    out["total_gasto"] = out.pop("gasto_total")
    out["num_tx_negativas"] = sum(r[3] == "Sale" and ((r[4] or 0) < 0 or r[5] < 0) for r in rows)
    for name, start, end in (("1m", 3, 0), ("3m", 6, 3), ("6m", 9, 3), ("12m", 15, 3)):
        out |= {f"{k}_{name}": v for k, v in measures(inside(start, end)).items()}
        tech = sum(r[4] or 0 for r in inside(start, end) if r[2] == "TECNOLOGIA")
        out[f"avg_gasto_tecnologia_{name}"] = tech / (start - end)
    year = inside(12)
    for category in ("COMIDAS", "DEPORTE", "TECNOLOGIA", "HOGAR"):
        out[f"gasto_{category}_12m"] = sum(r[4] or 0 for r in year if r[2] == category)
    named = sum(r[4] or 0 for r in year if r[2])
    out["share_named"] = out["gasto_TECNOLOGIA_12m"] / (named + 1)
    out["share_all"] = out["gasto_TECNOLOGIA_12m"] / (sum(r[4] or 0 for r in year) + 1)
    out["target"] = sum(r[0] is not None and r[2] == "TECNOLOGIA" for r in inside(3, 0))
    return out


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


@pytest.mark.parametrize("busy_rows", [20, 10**9])
def test_windows_do_not_depend_on_how_dates_are_joined(tables, busy_rows):
    tx, _ = tables
    anchored = with_anchor(tx, [0, 3, 6, 9, 15], busy_rows)
    got = {r["id_cliente"]: r for r in fe.per_customer(anchored, fe.profile_block(), fe.window_block()).collect()}
    grouped = by_customer()
    assert set(got) == set(grouped)
    for customer, rows in grouped.items():
        want = expected(rows)
        for name in got[customer].asDict():
            if name == "id_cliente":
                continue
            if name == "last_date":
                assert got[customer][name] == want[name]
            else:
                assert close(got[customer][name], want[name]), (customer, name)


def test_window_starts_at_the_last_day_of_a_short_month(tables):
    tx, _ = tables
    row = fe.window_features(tx).where("id_cliente = 78").first()
    assert (row["num_tx_1m"], row["gasto_1m"]) == (1, 20.0)
    assert (row["num_tx_3m"], row["gasto_3m"]) == (1, 40.0)


def test_customer_features(tables):
    tx, cust = tables
    df = cf.customer_features(tx, cust)
    assert [c for c in df.columns if c.startswith("gasto_") and c.endswith("_12m")][1:] == [
        f"gasto_{c}_12m" for c in ("COMIDA", "DEPORTE", "HOGAR", "TECNOLOGIA")
    ]
    grouped = by_customer()
    rows = df.collect()
    assert sorted(r["id_cliente"] for r in rows) == sorted(c[0] for c in make_customers())
    for row in rows:
        want = expected(grouped.get(row["id_cliente"], []))
        assert row["last_date"] == want["last_date"]
        assert abs(row["pct_tecnologia_12m"] - want["share_named"]) <= 0.0051
        assert row["compra_tecnologia"] == int(want["gasto_TECNOLOGIA_12m"] > 0)
        assert abs(row["gasto_COMIDA_12m"] - want["gasto_COMIDAS_12m"]) <= 0.0051
        assert abs(row["avg_gasto_tecnologia_6m"] - want["avg_gasto_tecnologia_6m"]) <= 0.0051
        assert abs(row["log_num_tx_total"] - math.log10(want["num_tx_total"] + 1)) <= 0.0051
        assert row["recencia_dias"] == 0
    idle = next(r for r in rows if r["id_cliente"] == 500)
    assert (idle["num_tx_total"], idle["edad"], idle["ciudad"], idle["last_date"]) == (0, 0, None, None)


def test_supervised_features(tables):
    tx, cust = tables
    df = cf.supervised_features(tx, cust)
    assert df.columns == ["id_cliente", *cf.SUPERVISED_FEATURES, fe.TARGET]
    rows = {r["id_cliente"]: r for r in df.collect()}
    grouped = by_customer()
    assert set(rows) == set(grouped)
    for customer, row in rows.items():
        want = expected(grouped[customer])
        n = want["target"]
        assert row[fe.TARGET] == ("alta" if n >= 4 else "media" if n >= 2 else "baja" if n else "sin_compra")
        assert close(row["gasto_6m"], want["gasto_6m"])
        assert close(row["pct_tecnologia_12m"], want["share_all"])
    stranger = rows[39]
    assert (stranger["estrato_social"], stranger["saldo_puntos"], stranger["edad"]) == (0, 0.0, 0)


def test_selected_features_default_to_no_purchase(tables):
    tx, cust = tables
    chosen = cf.selected_features(cf.customer_features(tx, cust), fe.target(tx))
    assert chosen.columns == ["id_cliente", *cf.SELECTED_FEATURES, fe.TARGET]
    assert chosen.where("id_cliente = 500").first()[fe.TARGET] == "sin_compra"


def test_missing_columns_are_named(tables):
    tx, cust = tables
    thin = cf.customer_features(tx, cust).drop("edad", "num_tx_1m")
    with pytest.raises(ValueError, match="num_tx_1m, edad"):
        cf.selected_features(thin, fe.target(tx))


def test_outer_joined_means_leave_gaps(tables):
    tx, _ = tables
    got = {r["id_cliente"]: r for r in fe.tech_means(tx).collect()}
    assert 77 not in got
    assert got[78]["avg_gasto_tecnologia_3m"] == pytest.approx(40 / 3)
    assert all(any(r[c] is not None for c in r.asDict() if c != "id_cliente") for r in got.values())


def test_windows_from_a_given_date(tables):
    tx, _ = tables
    as_of = datetime(2024, 5, 31)
    got = {r["id_cliente"]: r for r in fe.window_features_as_of(tx, 3, as_of).collect()}
    for customer, rows in by_customer().items():
        recent = [r for r in rows if r[1] and r[1] >= datetime(2024, 2, 29)]
        if recent:
            assert close(got[customer]["gasto_3m"], measures(recent)["gasto"])
        else:
            assert customer not in got


def test_recency_counts_days_to_a_given_date(tables):
    tx, _ = tables
    row = fe.profile(tx, datetime(2024, 6, 2)).where("id_cliente = 78").first()
    assert row["recencia_dias"] == 2
    undated = fe.profile(tx).where("id_cliente = 77").first()
    assert undated["recencia_dias"] is None
    assert last_transaction(tx).where(F.col("id_cliente").isNull()).count() == 0


def test_category_lookup_refuses_too_many(tables, monkeypatch):
    tx, _ = tables
    assert fe.category_values(tx) == ["COMIDAS", "DEPORTE", "HOGAR", "TECNOLOGIA"]
    monkeypatch.setattr(fe, "MAX_CATEGORIES", 2)
    with pytest.raises(ValueError, match="more than 2"):
        fe.category_values(tx)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_dates_are_aggregated_once(tables):
    """The table of latest dates serves the busy customers, those that are left out and all others."""
    tx, _ = tables
    plan = plan_of(with_anchor(tx, [3]))
    found = [line for line in plan.splitlines() if "HashAggregate" in line and "partial_" in line]
    assert all("partial_max" in line and "partial_count" in line for line in found), plan
    assert "SortMergeJoin" not in plan


def test_sums_are_touched_by_their_own_rows_only(tables):
    tx, cust = tables
    plan = cf.customer_features(tx, cust)._jdf.queryExecution().optimizedPlan().toString()
    assert "gasto_3m" in plan and "filter (where" in plan.lower()


@pytest.mark.parametrize("name", ["L'ORÉAL", "a\\b", 'say "so"', "x' OR 'y' = 'y"])
def test_category_names_of_any_kind(spark, name):
    rows = [
        (1, 5, "2024-05-31 00:00:00", name, "Sale", 10.0, 1.0),
        (2, 5, "2024-05-30 00:00:00", "HOGAR", "Sale", 32.0, 1.0),
        (3, 5, "2024-05-29 00:00:00", None, "Sale", 64.0, 1.0),
    ]
    tx = transactions(spark.createDataFrame(rows, TRANSACTIONS))
    row = fe.per_customer(with_anchor(tx, [fe.YEAR]), fe.category_block([name, "HOGAR"])).first()
    assert row[f"gasto_{name}_12m"] == 10.0
    assert (row["gasto_HOGAR_12m"], row["_gasto_12m"]) == (32.0, 42.0)
