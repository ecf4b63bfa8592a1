"""The queries again as plain SQL, for an independent engine on the same Parquet tables.

Every statement starts from the base tables and repeats the definitions on its own terms; only the
rounding of fractions to 6 decimals is shared with the registered queries.
"""

from __future__ import annotations

from collections.abc import Sequence

ORACLE: dict[str, str] = {}

BASE = """raw_transacciones AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS id_transaccion, o.o_custkey AS id_cliente,
    CAST(l.l_shipdate AS VARCHAR) AS fecha,
    CASE p.p_type WHEN 'ECONOMY' THEN 'TECNOLOGIA' WHEN 'SMALL' THEN 'SALUD Y BELLEZA' WHEN 'MEDIUM' THEN 'COMIDAS'
      WHEN 'PROMO' THEN 'DEPORTES' WHEN 'STANDARD' THEN 'LICORES Y CIGARRILLOS' ELSE 'HOGAR' END AS categoria,
    CASE WHEN l.l_returnflag = 'R' THEN 'Redemption' ELSE 'Sale' END AS tipo_transaccion,
    CASE WHEN l.l_orderkey % 97 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS valor_transaccion,
    CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS puntos
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
), members AS (
  SELECT c_custkey AS id_cliente, c_custkey AS member, c_nationkey AS nation, c_acctbal AS saldo_puntos,
    c_mktsegment AS segment FROM customer
  UNION ALL
  SELECT -s_suppkey - 1, s_suppkey, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
), raw_customers AS (
  SELECT m.id_cliente, n.n_name AS ciudad,
    CASE WHEN segment IN ('AUTOMOBILE', 'MACHINERY') THEN 'M'
      WHEN segment IN ('BUILDING', 'FURNITURE', 'SUPPLIER') THEN 'F' ELSE 'N' END AS genero,
    CAST(member % 6 + 1 AS INTEGER) AS estrato_social, saldo_puntos,
    CASE WHEN member % 50 = 0 THEN 'no-date'
      ELSE CAST(DATE '1920-01-01' + CAST(member * 37 % 36500 AS INTEGER) AS VARCHAR) END AS fecha_nacimiento
  FROM members m JOIN nation n ON m.nation = n.n_nationkey
), tx AS (
  SELECT * REPLACE (TRY_CAST(fecha AS TIMESTAMP) AS fecha) FROM raw_transacciones
), cust AS (
  SELECT * REPLACE (TRY_CAST(fecha_nacimiento AS TIMESTAMP) AS fecha_nacimiento) FROM raw_customers
), last_tx AS (
  SELECT id_cliente, max(fecha) AS last_date FROM tx WHERE id_cliente IS NOT NULL GROUP BY id_cliente
), dated AS (
  SELECT tx.*, last_date FROM tx JOIN last_tx USING (id_cliente)
), recoded AS (
  SELECT * REPLACE (CASE categoria WHEN 'COMIDAS' THEN 'COMIDA' WHEN 'DEPORTES' THEN 'DEPORTE'
    WHEN 'LICORES Y CIGARRILLOS' THEN 'LICORES' WHEN 'SALUD Y BELLEZA' THEN 'SALUD_BELLEZA'
    ELSE categoria END AS categoria) FROM dated
)"""

NEGATIVE = "tipo_transaccion = 'Sale' AND (valor_transaccion < 0 OR puntos < 0)"
TECH = "categoria = 'TECNOLOGIA'"
CATEGORIES = ["COMIDA", "DEPORTE", "HOGAR", "LICORES", "SALUD_BELLEZA", "TECNOLOGIA"]
GRID = [("1m", 3, 0), ("3m", 6, 3), ("6m", 9, 3), ("12m", 15, 3)]


def rounded(x: str, digits: int = 6) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits} + 0.0)"


def total(x: str, where: str = "true") -> str:
    return rounded(f"coalesce(sum({x}) FILTER (WHERE {where}), 0.0)")


def mean(x: str) -> str:
    return f"({rounded(f'sum(CAST({x} AS DOUBLE))')} / count({x}))"


def date_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def window(start: int, end: int) -> str:
    return f"(fecha >= last_date - INTERVAL {start} MONTH AND fecha < last_date - INTERVAL {end} MONTH)"


def block(name: str, inside: str) -> str:
    return f"""count(id_transaccion) FILTER (WHERE {inside}) AS num_tx_{name},
    {total('valor_transaccion', inside)} AS gasto_{name},
    {total('puntos', f'{inside} AND puntos > 0')} AS puntos_ganados_{name},
    {total('-puntos', f'{inside} AND puntos < 0')} AS puntos_redimidos_{name}"""


YEAR = "fecha >= last_date - INTERVAL 12 MONTH"
PROFILE = f"""count(id_transaccion) AS num_tx_total, {total('valor_transaccion')} AS total_gasto,
    {total('puntos', 'puntos > 0')} AS puntos_ganados_total, {total('-puntos', 'puntos < 0')} AS puntos_redimidos_total,
    CAST(CASE WHEN max(last_date) IS NOT NULL THEN 0 END AS BIGINT) AS recencia_dias,
    count(*) FILTER (WHERE {NEGATIVE}) AS num_tx_negativas"""
WINDOWS = ",\n    ".join(block(name, window(a, b)) for name, a, b in GRID)
PIVOT = ",\n    ".join(f"""{total('valor_transaccion', f"{YEAR} AND categoria = '{c}'")} AS "gasto_{c}_12m\"""" for c in CATEGORIES)
SHARE = """"gasto_TECNOLOGIA_12m" / (year_total + 1) AS pct_tecnologia_12m,
    CAST("gasto_TECNOLOGIA_12m" > 0 AS INTEGER) AS compra_tecnologia"""


def tech_mean(months: int, start: int, end: int) -> str:
    return f"{total('valor_transaccion', f'{window(start, end)} AND {TECH}')} / {months} AS avg_gasto_tecnologia_{months}m"


MEANS = ", ".join(tech_mean(a - b, a, b) for _, a, b in GRID[1:])
TARGET = f"count(id_transaccion) FILTER (WHERE {window(3, 0)} AND {TECH}) AS num_tx_target"


def label(high: int, middle: int, low: int, n: str = "num_tx_target") -> str:
    return (
        f"CASE WHEN {n} >= {high} THEN 'alta' WHEN {n} >= {middle} THEN 'media' "
        f"WHEN {n} >= {low} THEN 'baja' ELSE 'sin_compra' END"
    )


def full_days(later: str, earlier: str) -> str:
    return f"floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0)"


def age(at: str, born: str) -> str:
    return f"CAST(floor({full_days(at, born)} / 365) AS BIGINT)"


def statement(name: str, body: str, *tables: str) -> None:
    ORACLE[name] = "WITH " + ", ".join([BASE, *tables]) + "\n" + body


# Reports

statement(
    "rep_top_cities",
    """SELECT ciudad, count(DISTINCT id_cliente) AS total_usuarios FROM raw_customers GROUP BY ciudad
    ORDER BY total_usuarios DESC, ciudad LIMIT 2""",
)
statement(
    "rep_top_spend_category",
    f"""SELECT id_cliente, {rounded('sum(valor_transaccion)')} AS total_consumo FROM raw_transacciones
    WHERE categoria = 'SALUD Y BELLEZA' GROUP BY id_cliente ORDER BY total_consumo DESC, id_cliente LIMIT 10""",
)
REDEEMED = """redeemed AS (SELECT id_cliente, sum(puntos) AS total_puntos FROM raw_transacciones
    WHERE tipo_transaccion = 'Redemption' GROUP BY id_cliente)"""
statement(
    "rep_top_redeemed", "SELECT * FROM redeemed ORDER BY total_puntos DESC, id_cliente LIMIT 10", REDEEMED
)
statement(
    "rep_top_redeemed_magnitude", "SELECT * FROM redeemed ORDER BY total_puntos, id_cliente LIMIT 10", REDEEMED
)
statement(
    "rep_top_balance",
    "SELECT id_cliente, saldo_puntos FROM raw_customers ORDER BY saldo_puntos DESC, id_cliente LIMIT 10",
)
statement(
    "rep_redeem_and_balance",
    """SELECT t.id_cliente, t.total_puntos, c.saldo_puntos FROM redeemed t JOIN raw_customers c USING (id_cliente)
    ORDER BY c.saldo_puntos DESC, t.total_puntos DESC, t.id_cliente LIMIT 10""",
    REDEEMED,
)
statement(
    "rep_monthly_points",
    """SELECT strftime(CAST(fecha AS TIMESTAMP), '%Y-%m') AS mes,
    coalesce(sum(puntos) FILTER (tipo_transaccion = 'Sale'), 0) AS total_acumulacion,
    coalesce(sum(puntos) FILTER (tipo_transaccion = 'Redemption'), 0) AS total_redencion
    FROM raw_transacciones GROUP BY 1 ORDER BY 1""",
)

for report in ("top_cities", "top_spend_category", "top_redeemed", "top_redeemed_magnitude", "top_balance",
               "redeem_and_balance", "monthly_points"):  # the same reports, asked for in SQL
    ORACLE[f"sql_{report}"] = ORACLE[f"rep_{report}"]

# Exploration

CLEAN = f"""clean AS (SELECT * FROM (SELECT *, {age("TIMESTAMP '2024-01-01'", 'fecha_nacimiento')} AS edad
    FROM cust WHERE genero IN ('F', 'M')) WHERE edad BETWEEN 20 AND 100)"""
PER_CUSTOMER = f"""per_customer AS (SELECT id_cliente, count(*) AS num_transacciones,
    {rounded('sum(valor_transaccion)')} AS total_gastado FROM raw_transacciones WHERE id_cliente IS NOT NULL GROUP BY id_cliente)"""


def profile_rows(table: str, source: str, columns: Sequence[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{name}' AS "column", '{kind}' AS type, count({name}) AS non_null,
        count(*) AS rows, '{table}' AS "table" FROM {source}"""
        for i, (name, kind) in enumerate(columns)
    )


TX_COLUMNS = [
    ("id_transaccion", "bigint"),
    ("id_cliente", "bigint"),
    ("fecha", "timestamp_ntz"),
    ("categoria", "string"),
    ("tipo_transaccion", "string"),
    ("valor_transaccion", "double"),
    ("puntos", "double"),
]
CUSTOMER_COLUMNS = [
    ("id_cliente", "bigint"),
    ("ciudad", "string"),
    ("genero", "string"),
    ("estrato_social", "int"),
    ("saldo_puntos", "double"),
    ("fecha_nacimiento", "timestamp_ntz"),
]
statement(
    "eda_profile",
    profile_rows("raw_transacciones", "tx", TX_COLUMNS)
    + " UNION ALL "
    + profile_rows("raw_customers", "cust", CUSTOMER_COLUMNS),
)
statement(
    "eda_clean_customers",
    f"SELECT * REPLACE ({date_text('fecha_nacimiento')} AS fecha_nacimiento) FROM clean",
    CLEAN,
)
statement("eda_gender_counts", "SELECT genero, count(*) AS n FROM clean GROUP BY genero", CLEAN)


def histogram(name: str, table: str, source: str, value: str, bins: int) -> None:
    last = bins - 1
    statement(
        name,
        f"""SELECT bin, {rounded('lo + bin * step')} AS low,
        {rounded(f'CASE WHEN bin = {last} THEN hi ELSE lo + (bin + 1) * step END')} AS high,
        (SELECT count(*) FROM placed WHERE placed.bin = edges.bin) AS n FROM edges""",
        table,
        f"vals AS (SELECT v FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source}) WHERE v IS NOT NULL)",
        f"limits AS (SELECT lo, hi, (hi - lo) / {bins} AS step FROM (SELECT min(v) AS lo, max(v) AS hi FROM vals))",
        f"edges AS (SELECT CAST(k AS INTEGER) AS bin, lo, hi, step FROM limits, range(0, {bins}) r(k))",
        f"""placed AS (SELECT (SELECT max(bin) FROM edges WHERE edges.lo + edges.bin * edges.step <= vals.v) AS bin
        FROM vals)""",
    )


def log_value(x: str) -> str:
    return f"CASE WHEN {x} + 1 > 0 THEN log10({x} + 1) END"


histogram("eda_age_hist", CLEAN, "clean", "edad", 25)
histogram("eda_balance_hist", CLEAN, "clean", "saldo_puntos", 50)
histogram("eda_balance_log_hist", CLEAN, "clean", log_value("saldo_puntos"), 30)
histogram("eda_tx_count_hist", PER_CUSTOMER, "per_customer", "num_transacciones", 50)
histogram("eda_tx_count_log_hist", PER_CUSTOMER, "per_customer", log_value("num_transacciones"), 30)
histogram("eda_spend_hist", PER_CUSTOMER, "per_customer", "total_gastado", 50)
histogram("eda_spend_log_hist", PER_CUSTOMER, "per_customer", log_value("total_gastado"), 30)

# Feature blocks

statement("feat_last_tx", f"SELECT id_cliente, {date_text('last_date')} AS last_date FROM last_tx")
statement("feat_recode_category", "SELECT categoria, count(*) AS n FROM recoded GROUP BY categoria")
statement(
    "feat_negative_flags",
    f"SELECT id_transaccion, id_cliente, coalesce({NEGATIVE}, false) AS tx_negativa FROM raw_transacciones",
)
statement("feat_profile", f"SELECT id_cliente, {PROFILE} FROM dated GROUP BY id_cliente")
statement(
    "feat_profile_recency",
    f"""SELECT id_cliente, CAST({full_days("TIMESTAMP '2024-01-01'", 'last_date')} AS BIGINT) AS recencia_dias FROM last_tx""",
)
statement("feat_windows", f"SELECT id_cliente, {WINDOWS} FROM dated GROUP BY id_cliente")
RECENT = "fecha >= TIMESTAMP '2001-06-30' - INTERVAL 12 MONTH"
statement(
    "feat_windows_asof",
    f"SELECT id_cliente, {block('12m', 'true')} FROM tx WHERE {RECENT} AND id_cliente IS NOT NULL GROUP BY id_cliente",
)
statement(
    "feat_tech_avg_asof",
    f"""SELECT id_cliente, {rounded(total('valor_transaccion') + ' / 12')} AS avg_gasto_tecnologia_12m FROM tx
    WHERE {RECENT} AND {TECH} AND id_cliente IS NOT NULL GROUP BY id_cliente""",
)
PIVOTED = f"""pivoted AS (SELECT id_cliente, {PIVOT},
    {total('valor_transaccion', f'{YEAR} AND categoria IS NOT NULL')} AS year_total FROM recoded GROUP BY id_cliente)"""
statement(
    "feat_category_pivot",
    f"""SELECT * EXCLUDE (year_total) REPLACE ({rounded('pct_tecnologia_12m')} AS pct_tecnologia_12m)
    FROM (SELECT *, {SHARE} FROM pivoted)""",
    PIVOTED,
)


def mean_rounded(months: int) -> str:
    name = f"avg_gasto_tecnologia_{months}m"
    return f"{rounded(name)} AS {name}"


statement(
    "feat_tech_avg",
    f"""SELECT id_cliente, {', '.join(mean_rounded(m) for m in (3, 6, 12))}
    FROM (SELECT id_cliente, {MEANS} FROM dated GROUP BY id_cliente)""",
)


def one_mean(months: int, start: int, end: int) -> str:
    return f"""m{months} AS (SELECT id_cliente, {rounded(total('valor_transaccion') + f' / {months}')} AS avg_gasto_tecnologia_{months}m
    FROM dated WHERE {window(start, end)} AND {TECH} GROUP BY id_cliente)"""


statement(
    "feat_tech_avg_outer",
    """SELECT id_cliente, avg_gasto_tecnologia_3m, avg_gasto_tecnologia_6m, avg_gasto_tecnologia_12m
    FROM m3 FULL JOIN m6 USING (id_cliente) FULL JOIN m12 USING (id_cliente)""",
    one_mean(3, 6, 3),
    one_mean(6, 9, 3),
    one_mean(12, 15, 3),
)
TECH_YEAR = f"""tech_year AS (SELECT id_cliente, {total('valor_transaccion', f'{YEAR} AND {TECH}')} AS "gasto_TECNOLOGIA_12m",
    {total('valor_transaccion', YEAR)} AS year_total FROM dated WHERE last_date IS NOT NULL GROUP BY id_cliente)"""
statement(
    "feat_tech_12m",
    f"""SELECT * EXCLUDE (year_total) REPLACE ({rounded('pct_tecnologia_12m')} AS pct_tecnologia_12m)
    FROM (SELECT *, {SHARE} FROM tech_year)""",
    TECH_YEAR,
)
statement(
    "feat_demographics",
    f"""SELECT c.id_cliente, estrato_social, saldo_puntos, {age('last_date', 'fecha_nacimiento')} AS edad
    FROM cust c LEFT JOIN last_tx USING (id_cliente)""",
)
COUNTED = f"counted AS (SELECT id_cliente, {TARGET} FROM dated GROUP BY id_cliente)"
LABELLED = f"labelled AS (SELECT *, {label(4, 2, 1)} AS target_compra_tecnologia FROM counted)"
statement(
    "feat_target", f"SELECT *, {label(5, 3, 1)} AS target_cloud FROM labelled", COUNTED, LABELLED
)
statement(
    "feat_target_counts",
    "SELECT target_compra_tecnologia, count(*) AS n FROM labelled GROUP BY 1",
    COUNTED,
    LABELLED,
)

# Feature tables

ACTIVE = f"""active AS (SELECT id_cliente, last_date, {PROFILE}, {WINDOWS}, {PIVOT},
    {total('valor_transaccion', f'{YEAR} AND categoria IS NOT NULL')} AS year_total, {MEANS}
    FROM recoded GROUP BY id_cliente, last_date)"""
COUNT_NAMES = ["num_tx_total", "recencia_dias", "num_tx_negativas", *[f"num_tx_{name}" for name, _, _ in GRID]]
MEASURES = ["gasto", "puntos_ganados", "puntos_redimidos"]


def cents(x: str, name: str) -> str:
    return f'{rounded(f"coalesce({x}, 0.0)", 2)} AS "{name}"'


FULL_COLUMNS = [
    "c.id_cliente",
    "ciudad",
    "genero",
    "coalesce(estrato_social, 0) AS estrato_social",
    cents("saldo_puntos", "saldo_puntos"),
    f"{date_text('fecha_nacimiento')} AS fecha_nacimiento",
    f"{date_text('last_date')} AS last_date",
    "coalesce(num_tx_total, 0) AS num_tx_total",
    *[cents(n, n) for n in ("total_gasto", "puntos_ganados_total", "puntos_redimidos_total")],
    "coalesce(recencia_dias, 0) AS recencia_dias",
    "coalesce(num_tx_negativas, 0) AS num_tx_negativas",
    *[
        part
        for name, _, _ in GRID
        for part in (
            f"coalesce(num_tx_{name}, 0) AS num_tx_{name}",
            *[cents(f"{m}_{name}", f"{m}_{name}") for m in MEASURES],
        )
    ],
    *[cents(f'"gasto_{c}_12m"', f"gasto_{c}_12m") for c in CATEGORIES],
    cents('"gasto_TECNOLOGIA_12m" / (year_total + 1)', "pct_tecnologia_12m"),
    'CAST(coalesce("gasto_TECNOLOGIA_12m" > 0, false) AS INTEGER) AS compra_tecnologia',
    *[cents(f"avg_gasto_tecnologia_{m}m", f"avg_gasto_tecnologia_{m}m") for m in (3, 6, 12)],
    f"coalesce({age('last_date', 'fecha_nacimiento')}, 0) AS edad",
    cents(log_value("num_tx_total"), "log_num_tx_total"),
    cents(log_value("total_gasto"), "log_total_gasto"),
    cents(log_value("puntos_ganados_total"), "log_puntos_ganados"),
]
FULL = f"""features AS (SELECT {', '.join(FULL_COLUMNS)} FROM cust c LEFT JOIN active USING (id_cliente))"""
NUMERIC = [
    c.split(" AS ")[-1].strip('"').removeprefix("c.")
    for c in FULL_COLUMNS
    if c not in ("ciudad", "genero") and "strftime" not in c
]
statement("feat_customer", "SELECT * FROM features", ACTIVE, FULL)
statement("feat_customer_incremental", "SELECT * FROM features", ACTIVE, FULL)
statement("feat_customer_bucketed", "SELECT * FROM features", ACTIVE, FULL)
statement(
    "rep_active_customers_sketch",
    """SELECT ciudad, count(DISTINCT id_cliente) AS clientes_activos, true AS within_2_percent
    FROM tx JOIN cust USING (id_cliente) GROUP BY ciudad""",
)
LOADED = """good AS (SELECT * FROM raw_customers WHERE TRY_CAST(fecha_nacimiento AS TIMESTAMP) IS NOT NULL),
bad AS (SELECT * FROM raw_customers WHERE TRY_CAST(fecha_nacimiento AS TIMESTAMP) IS NULL)"""
statement(
    "load_accounted",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) AS rows FROM good"
        for c in ("id_cliente", "ciudad", "genero", "estrato_social", "saldo_puntos", "fecha_nacimiento")
    )
    + " UNION ALL SELECT 'fecha_nacimiento: ' || fecha_nacimiento, (SELECT count(*) FROM bad), count(*) FROM bad GROUP BY 1",
    LOADED,
)
statement(
    "eda_quantile_sketches",
    """SELECT feature, probability, n, true AS within_error FROM (
    SELECT 'valor_transaccion' AS feature, count(valor_transaccion) AS n FROM tx UNION ALL
    SELECT 'puntos', count(puntos) FROM tx), (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE]) AS probability)""",
)

SLIM = f"""slim AS (SELECT id_cliente, last_date, count(id_transaccion) AS num_tx_total,
    {total('valor_transaccion')} AS total_gasto, {block('3m', window(6, 3))}, {block('6m', window(9, 3))},
    {total('valor_transaccion', f'{YEAR} AND {TECH}')} AS "gasto_TECNOLOGIA_12m",
    {total('valor_transaccion', YEAR)} AS year_total, {tech_mean(3, 6, 3)}, {tech_mean(6, 9, 3)}, {TARGET}
    FROM dated GROUP BY id_cliente, last_date)"""


def plain(x: str, name: str) -> str:
    return f'{rounded(f"coalesce({x}, 0.0)")} AS "{name}"'


def exact(x: str, name: str) -> str:
    return f'coalesce({x}, 0.0) AS "{name}"'


def supervised_table(number) -> str:
    return f"""supervised AS MATERIALIZED (SELECT a.id_cliente, coalesce(estrato_social, 0) AS estrato_social, {number('saldo_puntos', 'saldo_puntos')},
    coalesce({age('last_date', 'fecha_nacimiento')}, 0) AS edad, num_tx_total, total_gasto,
    CAST(0 AS BIGINT) AS recencia_dias, {number(log_value('num_tx_total'), 'log_num_tx_total')},
    {number(log_value('total_gasto'), 'log_total_gasto')},
    num_tx_3m, gasto_3m, puntos_ganados_3m, puntos_redimidos_3m,
    num_tx_6m, gasto_6m, puntos_ganados_6m, puntos_redimidos_6m, "gasto_TECNOLOGIA_12m",
    {number('"gasto_TECNOLOGIA_12m" / (year_total + 1)', 'pct_tecnologia_12m')},
    CAST("gasto_TECNOLOGIA_12m" > 0 AS INTEGER) AS compra_tecnologia,
    {number('avg_gasto_tecnologia_3m', 'avg_gasto_tecnologia_3m')},
    {number('avg_gasto_tecnologia_6m', 'avg_gasto_tecnologia_6m')},
    {label(4, 2, 1)} AS target_compra_tecnologia
    FROM slim a LEFT JOIN cust c USING (id_cliente))"""


statement("feat_supervised", "SELECT * FROM supervised", SLIM, supervised_table(plain))
SUPERVISED_NUMBERS = [
    "estrato_social",
    "saldo_puntos",
    "edad",
    "num_tx_total",
    "total_gasto",
    "recencia_dias",
    "log_num_tx_total",
    "log_total_gasto",
    *[f"{m}_{name}" for name in ("3m", "6m") for m in ("num_tx", *MEASURES)],
    "gasto_TECNOLOGIA_12m",
    "pct_tecnologia_12m",
    "compra_tecnologia",
    "avg_gasto_tecnologia_3m",
    "avg_gasto_tecnologia_6m",
]
statement(
    "ml_standard_scale",
    f"""SELECT id_cliente, feature, {rounded('coalesce((value - mean) / nullif(deviation, 0), 0)')} AS value
    FROM tall JOIN (SELECT feature, avg(value) AS mean, stddev_pop(value) AS deviation FROM tall GROUP BY feature)
    USING (feature)""",
    SLIM,
    supervised_table(exact),
    "tall AS MATERIALIZED ("
    + " UNION ALL ".join(
        f"""SELECT id_cliente, '{c}' AS feature, CAST("{c}" AS DOUBLE) AS value FROM supervised"""
        for c in SUPERVISED_NUMBERS
    )
    + ")",
)
SELECTED = [
    "num_tx_total",
    "total_gasto",
    "recencia_dias",
    "log_num_tx_total",
    "log_total_gasto",
    "gasto_TECNOLOGIA_12m",
    "pct_tecnologia_12m",
    "avg_gasto_tecnologia_3m",
    "avg_gasto_tecnologia_6m",
    "num_tx_1m",
    "puntos_redimidos_1m",
    "puntos_redimidos_3m",
    "edad",
    "estrato_social",
    "saldo_puntos",
]
statement(
    "feat_supervised_selected",
    f"""SELECT f.id_cliente, {', '.join(f'"{c}"' for c in SELECTED)},
    coalesce(target_compra_tecnologia, 'sin_compra') AS target_compra_tecnologia
    FROM features f LEFT JOIN labelled USING (id_cliente)""",
    ACTIVE,
    FULL,
    COUNTED,
    LABELLED,
)

# Correlation

NUMBERED = "numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS line FROM features)"
LONG = "cells AS MATERIALIZED (" + " UNION ALL ".join(
    f"""SELECT line, id_cliente AS customer, {i} AS pos, '{c}' AS feature, CAST("{c}" AS DOUBLE) AS value FROM numbered"""
    for i, c in enumerate(NUMERIC)
) + ")"
PAIRS = """pairs AS MATERIALIZED (SELECT a.pos AS p1, b.pos AS p2, a.feature AS feature_1, b.feature AS feature_2,
    CASE WHEN min(a.value) < max(a.value) AND min(b.value) < max(b.value) THEN corr(a.value, b.value) END AS correlation
    FROM cells a JOIN cells b USING (line) GROUP BY ALL)"""
STRONG = "strong AS MATERIALIZED (SELECT * FROM pairs WHERE p1 < p2 AND abs(correlation) >= 0.9)"
KEPT = """kept AS MATERIALIZED (SELECT customer, pos, c.feature, value FROM cells c
    LEFT JOIN (SELECT DISTINCT feature_2 AS feature FROM strong) gone ON c.feature = gone.feature WHERE gone.feature IS NULL)"""
FEATURES = [ACTIVE, FULL, NUMBERED, LONG, PAIRS, STRONG, KEPT]
statement(
    "stat_correlation", f"SELECT feature_1, feature_2, {rounded('correlation')} AS correlation FROM pairs", *FEATURES
)
statement(
    "stat_correlation_blocks", f"SELECT feature_1, feature_2, {rounded('correlation')} AS correlation FROM pairs", *FEATURES
)
statement(
    "stat_high_pairs",
    f"SELECT feature_1, feature_2, {rounded('abs(correlation)')} AS correlation FROM strong",
    *FEATURES,
)
statement(
    "stat_redundant", "SELECT feature_2 AS feature, count(*) AS repeats FROM strong GROUP BY feature_2", *FEATURES
)
statement("stat_reduced", "SELECT customer, feature, value FROM kept", *FEATURES)

# Clustering

statement(
    "clu_features",
    "SELECT customer AS id_cliente, feature, value FROM kept WHERE feature <> 'id_cliente'",
    *FEATURES,
)
statement(
    "clu_robust_scale",
    f"""SELECT customer AS id_cliente, feature,
    {rounded('(value - q2) / CASE WHEN q3 = q1 THEN 1.0 ELSE q3 - q1 END')} AS value
    FROM kept JOIN (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
      quantile_cont(value, 0.75) AS q3 FROM kept GROUP BY feature) USING (feature) WHERE feature <> 'id_cliente'""",
    *FEATURES,
)
statement(
    "clu_profile_stratum",
    "SELECT estrato_social, "
    + ", ".join(f'{rounded(mean(c), 2)} AS "{c}"' for c in NUMERIC if c != "estrato_social")
    + " FROM features GROUP BY estrato_social",
    ACTIVE,
    FULL,
)

POINTS = """points AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
dims AS (SELECT vec_id, cluster, unnest(x) AS v, generate_subscripts(x, 1) AS d FROM points),
centres AS (SELECT cluster, list(m ORDER BY d) AS centre FROM (
    SELECT cluster, d, avg(v) AS m FROM dims GROUP BY cluster, d) GROUP BY cluster),
spread AS (SELECT cluster, count(*) AS size, avg(list_distance(x, centre)) AS scatter,
    sum(list_distance(x, centre) ** 2) AS within_sum, any_value(centre) AS centre
    FROM points JOIN centres USING (cluster) GROUP BY cluster)"""
DB = f"""SELECT {rounded('avg(worst)')} AS value FROM (
    SELECT max((a.scatter + b.scatter) / list_distance(a.centre, b.centre)) AS worst
    FROM spread a JOIN spread b ON a.cluster <> b.cluster GROUP BY a.cluster)"""
CH = f"""SELECT {rounded('b * (n - k) / (w * (k - 1))')} AS value FROM (
    SELECT sum(size * list_distance(centre, (SELECT list(m ORDER BY d) FROM (SELECT d, avg(v) AS m FROM dims GROUP BY d))) ** 2) AS b,
    sum(within_sum) AS w, CAST(sum(size) AS DOUBLE) AS n, count(*) AS k FROM spread)"""
SILHOUETTE = f"""SELECT {rounded('avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END)')} AS value FROM (
    SELECT vec_id, max(members) FILTER (WHERE own = other) AS size,
    max(distance / nullif(members - 1, 0)) FILTER (WHERE own = other) AS a,
    min(distance / members) FILTER (WHERE own <> other) AS b
    FROM (SELECT p.vec_id, p.cluster AS own, q.cluster AS other, sum(list_distance(p.x, q.x)) AS distance,
      count(*) AS members FROM points p, points q GROUP BY ALL) GROUP BY vec_id)"""
statement("clu_davies_bouldin", DB, POINTS)
statement("clu_calinski", CH, POINTS)
SQUARED = """sums AS (SELECT cluster AS c, d, sum(v) AS y FROM dims GROUP BY ALL),
    sizes AS (SELECT cluster AS c, count(*) AS n, sum(list_dot_product(x, x)) AS psi FROM points GROUP BY ALL),
    dots AS (SELECT vec_id, c, sum(v * y) AS dot FROM dims JOIN sums USING (d) GROUP BY ALL),
    gaps AS (SELECT vec_id, cluster = c AS own, n, (n * list_dot_product(x, x) + psi - 2 * dot)
      / CASE WHEN cluster = c THEN greatest(n - 1, 1) ELSE n END AS gap
      FROM dots JOIN points USING (vec_id) JOIN sizes USING (c)),
    pairs AS (SELECT vec_id, max(n) FILTER (own) AS n, max(gap) FILTER (own) AS a, min(gap) FILTER (NOT own) AS b
      FROM gaps GROUP BY ALL)"""
statement(
    "clu_silhouette_squared",
    "SELECT 'cluster' AS labelling, avg(CASE WHEN n = 1 OR a = b THEN 0 ELSE (b - a) / greatest(a, b) END) AS value FROM pairs",
    POINTS,
    SQUARED,
)
# With no more than 256 vectors to a label there is a summary for each, and no error.
statement("clu_silhouette_bounds", f"SELECT 'cluster' AS labelling, value, 0.0::DOUBLE AS error FROM ({SILHOUETTE})", POINTS)
statement(
    "clu_summary_totals",
    f"""SELECT CAST(cluster AS BIGINT) AS label, size AS points, {rounded('within_sum')} AS squared, true AS within_limit FROM spread""",
    POINTS,
)
statement("clu_silhouette", f"SELECT 'cluster' AS labelling, value FROM ({SILHOUETTE})", POINTS)
statement(
    "clu_metrics",
    f"""SELECT 'silhouette' AS metric, value FROM ({SILHOUETTE}) UNION ALL
    SELECT 'davies_bouldin', value FROM ({DB}) UNION ALL SELECT 'calinski_harabasz', value FROM ({CH})""",
    POINTS,
)

# Supervised learning and evaluation

CLASSES = "['sin_compra', 'baja', 'media', 'alta']"
RATED = f"""{SLIM}, {supervised_table(plain)}, rated AS (SELECT *, CASE WHEN score > -0.5 AND score <= 0.5 THEN 'sin_compra'
    WHEN score > 0.5 AND score <= 1.5 THEN 'baja' WHEN score > 1.5 AND score <= 2.5 THEN 'media'
    WHEN score > 2.5 AND score <= 3.5 THEN 'alta' END AS predicted FROM (
    SELECT id_cliente, target_compra_tecnologia AS truth,
    CAST(list_position({CLASSES}, target_compra_tecnologia) - 1 AS INTEGER) AS code,
    total_gasto / (total_gasto + 500000) * 4.6::DOUBLE - 0.8::DOUBLE AS score,
    CASE WHEN target_compra_tecnologia = 'sin_compra' THEN 0 ELSE 1 END AS bought,
    total_gasto / (total_gasto + 1000000) AS chance FROM supervised))"""
statement(
    "ml_bin_scores",
    f"SELECT id_cliente, truth, {rounded('score')} AS score, code, predicted FROM rated",
    RATED,
)
statement("ml_mae", f"SELECT {rounded(mean('abs(code - score)'))} AS mae_ordinal FROM rated", RATED)
statement(
    "ml_accuracy",
    f"SELECT {rounded('avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM rated",
    RATED,
)
statement(
    "ml_confusion",
    f"""SELECT t.c AS truth, p.c AS predicted,
    (SELECT count(*) FROM rated r WHERE r.truth = t.c AND r.predicted = p.c) AS n
    FROM (SELECT unnest({CLASSES}) AS c) t, (SELECT unnest({CLASSES}) AS c) p""",
    RATED,
)
RATIOS = f"""ratios AS (SELECT c AS label, coalesce(hits / nullif(called, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r,
    coalesce(2 * hits / nullif(called + support, 0), 0) AS f, support FROM (
    SELECT c, CAST(count(*) FILTER (WHERE truth = c AND predicted = c) AS DOUBLE) AS hits,
    CAST(count(*) FILTER (WHERE predicted = c) AS DOUBLE) AS called,
    CAST(count(*) FILTER (WHERE truth = c) AS DOUBLE) AS support
    FROM rated, (SELECT unnest({CLASSES}) AS c) GROUP BY c))"""
statement(
    "ml_class_report",
    f"""SELECT label, {rounded('p')} AS precision, {rounded('r')} AS recall, {rounded('f')} AS f1_score, support FROM (
    SELECT label, p, r, f, support FROM ratios UNION ALL
    SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM ratios UNION ALL
    SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
      sum(f * support) / sum(support), sum(support) FROM ratios UNION ALL
    SELECT 'accuracy', a, a, a, n FROM (SELECT avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) AS a,
      CAST(count(*) AS DOUBLE) AS n FROM rated))""",
    RATED,
    RATIOS,
)
statement(
    "ml_roc_auc",
    f"""SELECT {rounded('(sum(CASE WHEN bought = 1 THEN mid END) - np * (np + 1) / 2.0) / (np * nn)')} AS roc_auc FROM (
    SELECT bought, rank() OVER (ORDER BY chance) + (count(*) OVER (PARTITION BY chance) - 1) / 2.0 AS mid,
    CAST(sum(bought) OVER () AS DOUBLE) AS np, CAST(sum(1 - bought) OVER () AS DOUBLE) AS nn FROM rated) GROUP BY np, nn""",
    RATED,
)
statement(
    "ml_roc_curve",
    f"""SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL
    SELECT {rounded('chance')}, {rounded('sum(n) OVER w / sum(n) OVER ()')}, {rounded('sum(p) OVER w / sum(p) OVER ()')}
    FROM (SELECT chance, CAST(sum(1 - bought) AS DOUBLE) AS n, CAST(sum(bought) AS DOUBLE) AS p FROM rated GROUP BY chance)
    WINDOW w AS (ORDER BY chance DESC)""",
    RATED,
)
QUOTAS = """sizes AS (SELECT target_compra_tecnologia AS c, count(*) AS n FROM labelled GROUP BY 1),
shares AS (SELECT c, n, n * train / total AS exact, train FROM (
    SELECT c, n, sum(n) OVER () AS total, sum(n) OVER () - ceil(sum(n) OVER () * 0.25) AS train FROM sizes)),
quotas AS (SELECT c, n, n - CAST(floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, c)
    <= train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS test_n FROM shares)"""
SPLIT = """split AS (SELECT id_cliente, target_compra_tecnologia, row_number() OVER (PARTITION BY target_compra_tecnologia
    ORDER BY md5(id_cliente || '-42'), id_cliente) <= test_n AS is_test
    FROM labelled JOIN quotas ON target_compra_tecnologia = c)"""
statement("ml_split", "SELECT * FROM split", COUNTED, LABELLED, QUOTAS, SPLIT)
statement(
    "ml_split_counts",
    """SELECT target_compra_tecnologia, count(*) FILTER (WHERE NOT is_test) AS train_rows,
    count(*) FILTER (WHERE is_test) AS test_rows FROM split GROUP BY 1""",
    COUNTED,
    LABELLED,
    QUOTAS,
    SPLIT,
)


# What every fitted model has to meet: the conditions of its minimum, by name.
SLIM_FEATURES = [
    "estrato_social",
    "saldo_puntos",
    "edad",
    "num_tx_total",
    "total_gasto",
    "recencia_dias",
    "log_num_tx_total",
    "log_total_gasto",
    "num_tx_3m",
    "gasto_3m",
    "puntos_ganados_3m",
    "puntos_redimidos_3m",
    "num_tx_6m",
    "gasto_6m",
    "puntos_ganados_6m",
    "puntos_redimidos_6m",
    "gasto_TECNOLOGIA_12m",
    "pct_tecnologia_12m",
    "compra_tecnologia",
    "avg_gasto_tecnologia_3m",
    "avg_gasto_tecnologia_6m",
]
ORACLE["ml_elasticnet_optimality"] = f"SELECT unnest({['intercept', *SLIM_FEATURES]}) AS condition, true AS holds"
ORACLE["ml_huber_optimality"] = f"SELECT unnest({['intercept', 'scale', *SLIM_FEATURES]}) AS condition, true AS holds"

FORMULAS = {"flat": 3.0, "plain": 4.6, "steep": 6.0}
SCORED = f"""{SLIM}, {supervised_table(plain)}, scored AS (SELECT *, CASE WHEN score > -0.5 AND score <= 0.5 THEN 'sin_compra'
    WHEN score > 0.5 AND score <= 1.5 THEN 'baja' WHEN score > 1.5 AND score <= 2.5 THEN 'media'
    WHEN score > 2.5 AND score <= 3.5 THEN 'alta' END AS predicted FROM (
    SELECT model, target_compra_tecnologia AS truth, list_position({CLASSES}, target_compra_tecnologia) - 1 AS code,
    total_gasto / (total_gasto + 500000) * factor - 0.8::DOUBLE AS score FROM supervised, (
    {' UNION ALL '.join(f"SELECT '{n}' AS model, {f}::DOUBLE AS factor" for n, f in FORMULAS.items())})))"""
MEASURED = f"""hits AS (SELECT model, avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) AS accuracy,
    {rounded(mean('abs(code - score)'))} AS mae FROM scored GROUP BY model),
per_class AS (SELECT model, c, CAST(count(*) FILTER (WHERE truth = c AND predicted = c) AS DOUBLE) AS hit,
    CAST(count(*) FILTER (WHERE predicted = c) AS DOUBLE) AS called, CAST(count(*) FILTER (WHERE truth = c) AS DOUBLE) AS support
    FROM scored, (SELECT unnest({CLASSES}) AS c) GROUP BY ALL),
weighted AS (SELECT model, sum(coalesce(2 * hit / nullif(called + support, 0), 0) * support) / sum(support) AS f1
    FROM per_class GROUP BY model)"""
statement(
    "ml_metrics_of_scores",
    f"""SELECT model, 'mae_ordinal' AS metric, mae AS value FROM hits UNION ALL
    SELECT model, 'accuracy', {rounded('accuracy')} FROM hits UNION ALL SELECT model, 'weighted_f1', {rounded('f1')} FROM weighted""",
    SCORED,
    MEASURED,
)
statement("ml_compare_of_scores", "SELECT model, mae AS mae_ordinal FROM hits", SCORED, MEASURED)
