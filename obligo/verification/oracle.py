"""DuckDB SQL for every registered query, written from the semantics, not from the Spark plans.

Attribution is spelled out literally here: join first, SELECT DISTINCT of whole rows, aggregate.
Every transaction has a row number of its own, so DISTINCT removes what the join repeats and
never a transaction that happens to equal another.
"""

from __future__ import annotations

from obligo.verification.fixtures import ROSTER_MIN_START, SEAT_MIN_START


def number(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({text}), '^[+-]?[0-9]+$')"
        f" THEN TRY_CAST(trim({text}) AS BIGINT) END"
    )


def year(text: str, early: str = "compat") -> str:
    last, first = f"({number(f'right({text}, 4)')})", f"({number(f'substr({text}, 1, 4)')})"
    below = f"CASE WHEN {first} IS NOT NULL THEN {last} END" if early == "compat" else first
    return (
        f"CASE WHEN {last} >= 1300 THEN {last}"
        f" WHEN {last} IS NOT NULL THEN {below} ELSE {first} END"
    )


def district(text: str) -> str:
    return number(f"(CASE WHEN length({text}) > 2 THEN right({text}, 2) ELSE {text} END)")


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Exact decimal rounding of a quotient of whole numbers, half away from zero."""
    n, d = f"(CAST({numerator} AS HUGEINT) * {10**digits})", f"CAST({denominator} AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


def md5_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def money(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


# -- source tables ------------------------------------------------------------------------

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTE[name] = (needs.split(), body)


def with_ctes(needs: str, select: str) -> str:
    """Puts the CTEs a statement needs, and those they need, in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in CTE[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    listed = ",\n".join(f"{name} AS ({CTE[name][1]})" for name in order)
    return f"WITH {listed}\n{select}" if listed else select


cte("txn", "", """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(l_extendedprice AS DECIMAL(18,2))) AS txn_id,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%m/%d/%Y')
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS action_date,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END
           AS DECIMAL(18,2)) AS federal_action_obligation,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS legal_entity_state_code,
         CASE WHEN c_custkey % 11 = 0 THEN 'ZZ' WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                || lpad(CAST(c_custkey % 5 AS VARCHAR), 2, '0')
              ELSE CAST(c_custkey % 5 AS VARCHAR) END AS legal_entity_congressional,
         '11' || lpad(substr(p_brand, 7), 2, '0') || lpad(CAST(p_size AS VARCHAR), 2, '0')
           AS naics,
         p_type AS cfda_title,
         CASE WHEN c_nationkey % 4 = 0 THEN 'USA' ELSE 'UNITED STATES' END
           AS legal_entity_country_code
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""")

cte("naics", "", """
  SELECT DISTINCT '11' || lpad(substr(p_brand, 7), 2, '0') AS code,
         'Industry ' || lpad(substr(p_brand, 7), 2, '0') AS description, 2017 AS year
    FROM part WHERE CAST(substr(p_brand, 7) AS INT) <= 20
  UNION ALL
  SELECT DISTINCT
         '11' || lpad(substr(p_brand, 7), 2, '0') || lpad(CAST(p_size AS VARCHAR), 2, '0'),
         'Niche ' || lpad(substr(p_brand, 7), 2, '0') || '-' || lpad(CAST(p_size AS VARCHAR), 2, '0'),
         2017
    FROM part WHERE p_size <= 10
  UNION ALL SELECT '9999', 'No contracts here', 2017
  UNION ALL
  SELECT DISTINCT '11' || lpad(substr(p_brand, 7), 2, '0'),
         'Former Industry ' || lpad(substr(p_brand, 7), 2, '0'), 2012
    FROM part WHERE CAST(substr(p_brand, 7) AS INT) <= 20
  UNION ALL SELECT '9999', 'Former No contracts here', 2012""")

cte("state_data", "", """
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name, y AS year,
         CASE WHEN n_nationkey <> 24 THEN CAST(500000 + 37001 * n_nationkey + (y - 2000) * 1000
           + (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS INT) END
           AS population,
         CAST(40000.25 + 711 * n_nationkey AS DECIMAL(12,2)) AS median_household_income
    FROM nation, unnest([2000, 2010]) AS v(y) WHERE n_nationkey <> 23""")

cte("labels_all", "naics", "SELECT code, description FROM naics WHERE year = 2017")
cte("labels_4", "naics",
    "SELECT code, description FROM naics WHERE year = 2017 AND length(code) = 4")
cte("states", "state_data", """
  SELECT code AS state, name AS state_name, population, median_household_income
    FROM state_data WHERE year = 2010""")

cte("seat_terms", "", """
  SELECT 'F' || n_nationkey AS firstname,
         'L' || n_nationkey || '_' || d || CASE WHEN s = 2001 THEN 'b' ELSE '' END AS lastname,
         CASE WHEN d >= 8 THEN 'sen' ELSE 'rep' END AS typeofrep,
         CASE WHEN (n_nationkey + d) % 7 = 0 THEN 'Independent'
              WHEN (n_nationkey + d) % 2 = 0 THEN 'Democrat' ELSE 'Republican' END AS party,
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state,
         CASE WHEN d = 9 THEN NULL WHEN d = 8 THEN 3 ELSE CAST(d AS BIGINT) END AS district,
         CAST(s AS BIGINT) AS start_year, CAST(s + 2 AS BIGINT) AS end_year, s >= 1999 AS is_current
    FROM nation, unnest([0, 1, 2, 3, 4, 8, 9]) AS t(d), unnest([1995, 1997, 1999, 2001]) AS u(s)
   WHERE d <> 8 OR n_nationkey % 5 = 0""")

cte("roster_terms", "", """
  SELECT 'F' || (o_custkey % 97) AS firstname, 'L' || o_orderkey AS lastname,
         CASE WHEN o_orderkey % 6 = 0 THEN 'sen' ELSE 'rep' END AS typeofrep,
         CASE WHEN o_custkey % 7 = 0 THEN 'Independent'
              WHEN o_custkey % 2 = 0 THEN 'Democrat' ELSE 'Republican' END AS party,
         lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') AS state,
         CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 40 END AS district,
         CAST(year(o_orderdate) + 2 * i AS BIGINT) AS start_year,
         CAST(year(o_orderdate) + 2 * i
           + CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE o_custkey % 4 END AS BIGINT) AS end_year,
         o_orderkey % 3 = 0 AS is_current
    FROM (SELECT *, unnest(generate_series(0, CAST(o_orderkey % 4 AS INT))) AS i FROM orders)""")


def _years(terms: str, where: str) -> str:
    return f"""
  SELECT firstname, lastname, typeofrep, party, state, district, CAST(year AS BIGINT) AS year
    FROM (SELECT *, unnest(generate_series(start_year, end_year)) AS year
            FROM {terms} WHERE end_year >= start_year AND {where})"""


cte("legislators", "seat_terms",
    _years("seat_terms", f"(is_current OR start_year >= {SEAT_MIN_START})"))
cte("roster_years", "roster_terms",
    _years("roster_terms", f"(is_current OR start_year >= {ROSTER_MIN_START})"))

cte("contracts_raw", "txn", """
  SELECT txn_id, action_date AS year, federal_action_obligation AS amount,
         legal_entity_state_code AS state, legal_entity_congressional AS district,
         naics AS code, legal_entity_country_code AS country_code FROM txn""")
cte("grants_raw", "txn", """
  SELECT txn_id, action_date AS year, federal_action_obligation AS amount,
         legal_entity_state_code AS state, legal_entity_congressional AS district,
         cfda_title AS industry, legal_entity_country_code AS country_code FROM txn""")
_COUNTRY = "CASE WHEN country_code = 'USA' THEN 'UNITED STATES' ELSE country_code END"


def _clean_cte(code: str, raw: str) -> str:
    return f"""
  SELECT row_number() OVER () AS rno, txn_id, {year('year')} AS year, amount, state,
         {district('district')} AS district, {code} AS code, {_COUNTRY} AS country_code
    FROM {raw}"""


cte("contracts", "contracts_raw", _clean_cte("substr(code, 1, 4)", "contracts_raw"))
cte("contracts_full", "contracts_raw", _clean_cte("code", "contracts_raw"))
cte("grants", "grants_raw", f"""
  SELECT row_number() OVER () AS rno, txn_id, {year('year')} AS year, amount, state, district,
         industry, country_code FROM grants_raw""")

cte("combined", "contracts labels_4 states legislators", """
  SELECT c.*, description, state_name, population, median_household_income,
         firstname, lastname, typeofrep, party
    FROM contracts c LEFT JOIN labels_4 USING (code) LEFT JOIN states USING (state)
    LEFT JOIN legislators l ON c.state = l.state AND c.district = l.district
     AND c.year = l.year""")
cte("combined_state", "contracts labels_4 states legislators", """
  SELECT c.* REPLACE (CAST(NULL AS BIGINT) AS district), description, state_name, population,
         median_household_income, firstname, lastname, typeofrep, party
    FROM contracts c LEFT JOIN labels_4 USING (code) LEFT JOIN states USING (state)
    LEFT JOIN legislators l ON c.state = l.state AND c.year = l.year AND l.typeofrep = 'sen'""")


def _legislator_mart(chamber: str, rows: str = "combined") -> str:
    return f"""
  SELECT firstname, lastname, max(typeofrep) AS typeofrep, max(party) AS party,
         max(CAST(district AS VARCHAR)) AS district, max(state_name) AS state_name,
         max(population) AS population, max(median_household_income) AS med_hh_income,
         sum(amount) AS amount, CAST(year AS VARCHAR) AS year, description
    FROM (SELECT DISTINCT * FROM {rows} WHERE typeofrep = '{chamber}')
   GROUP BY year, firstname, lastname, description"""


def _industry_mart(chamber: str, rows: str = "combined") -> str:
    return f"""
  SELECT sum(amount) AS amount, max(state_name) AS state_name, max(population) AS population,
         max(median_household_income) AS med_hh_income, CAST(year AS VARCHAR) AS year,
         description, state, party
    FROM (SELECT DISTINCT * FROM {rows} WHERE typeofrep = '{chamber}')
   WHERE description IS NOT NULL GROUP BY description, year, state, party"""


def _state_mart(chamber: str, rows: str = "combined") -> str:
    per_head = half_up(cents("amount"), "population * 100", 6)
    per_dollar = half_up(cents("amount"), cents("median_household_income"), 6)
    return f"""
  SELECT sum(amount) AS amount, max(state_name) AS state_name, max(population) AS population,
         max(median_household_income) AS med_hh_income,
         CAST(sum({per_head}) AS DECIMAL(38,0)) / 1000000 AS contract_pp,
         CAST(sum({per_dollar}) AS DECIMAL(38,0)) / 1000000 AS contract_pd,
         CAST(year AS VARCHAR) AS year, state, party
    FROM (SELECT DISTINCT * FROM {rows} WHERE typeofrep = '{chamber}')
   GROUP BY year, state, party"""


cte("combined_roster", "contracts labels_4 states roster_years",
    CTE["combined"][1].replace("LEFT JOIN legislators l", "JOIN roster_years l"))
cte("legis_hr", "combined", _legislator_mart("rep"))
cte("indus_hr", "combined", _industry_mart("rep"))

_MARTS = {"legis": _legislator_mart, "indus": _industry_mart, "state": _state_mart}
_MART_COLUMNS = {
    "legis": "firstname, lastname, typeofrep, party, district, state_name, population, "
    "CAST(med_hh_income AS DOUBLE) AS med_hh_income, CAST(amount AS DOUBLE) AS amount, year, "
    "description",
    "indus": "CAST(amount AS DOUBLE) AS amount, state_name, population, "
    "CAST(med_hh_income AS DOUBLE) AS med_hh_income, year, description, state, party",
    "state": "CAST(amount AS DOUBLE) AS amount, state_name, population, "
    "CAST(med_hh_income AS DOUBLE) AS med_hh_income, CAST(contract_pp AS DOUBLE) AS contract_pp, "
    "CAST(contract_pd AS DOUBLE) AS contract_pd, year, state, party",
}


def mart(kind: str, chamber: str, rows: str = "combined", extra: str = "") -> str:
    body = _MARTS[kind](chamber, rows)
    return with_ctes(rows, f"SELECT {_MART_COLUMNS[kind]}{extra} FROM ({body})")


cte("snap_old", "contracts_raw", "SELECT * FROM contracts_raw")
cte("snap_new", "contracts_raw", """
  SELECT txn_id, year,
         CAST(CASE WHEN txn_id LIKE '%7-1-%' THEN amount + 1 ELSE amount END AS DECIMAL(18,2))
           AS amount, state, district, code, country_code
    FROM contracts_raw WHERE txn_id NOT LIKE '%9-2-%'
  UNION ALL
  SELECT txn_id || '-n', year, amount, state, district, code, country_code
    FROM contracts_raw WHERE txn_id LIKE '%3-4-%'""")
cte("snap_kept", "snap_new snap_old",
    "SELECT * FROM snap_new WHERE txn_id IN (SELECT txn_id FROM snap_old)")
_PER_KEY = (
    "SELECT txn_id, sum(amount) AS amount,"
    " list_sort(list(coalesce(CAST(amount AS VARCHAR), 'null'))) AS bag FROM {} GROUP BY txn_id"
)
cte("snap_diff", "snap_old snap_new", f"""
  SELECT coalesce(o.txn_id, n.txn_id) AS txn_id, o.amount AS old_amount, n.amount AS new_amount,
         CASE WHEN o.txn_id IS NULL THEN 'new' WHEN n.txn_id IS NULL THEN 'missing'
              ELSE 'changed' END AS status
    FROM ({_PER_KEY.format('snap_old')}) o
    FULL OUTER JOIN ({_PER_KEY.format('snap_new')}) n ON o.txn_id = n.txn_id
   WHERE o.txn_id IS NULL OR n.txn_id IS NULL OR o.bag <> n.bag""")
cte("local_old", "contracts_raw", """
  SELECT * FROM contracts_raw
  UNION ALL SELECT * REPLACE ('07' AS state) FROM contracts_raw WHERE txn_id LIKE '%5-3-%'""")
cte("local_new", "local_old", """
  SELECT * REPLACE (CAST(CASE WHEN state = '07' AND txn_id LIKE '%7-1-%' THEN amount + 1
                              ELSE amount END AS DECIMAL(18,2)) AS amount)
    FROM local_old WHERE NOT coalesce(state = '07' AND txn_id LIKE '%15-3-%', FALSE)""")
cte("local_diff", "local_old local_new", CTE["snap_diff"][1]
    .replace("snap_old", "local_old").replace("snap_new", "local_new"))
cte("snap_appended", "snap_old snap_new", """
  SELECT * FROM snap_old
  UNION ALL SELECT * FROM snap_new WHERE txn_id NOT IN (SELECT txn_id FROM snap_old)""")
cte("contracts_appended", "snap_appended", _clean_cte("substr(code, 1, 4)", "snap_appended"))
cte("combined_appended", "contracts_appended labels_4 states legislators",
    CTE["combined"][1].replace("FROM contracts c", "FROM contracts_appended c"))


def fingerprint(rows: str, by: str = "") -> str:
    h = md5_number("concat_ws('|', coalesce(txn_id, 'null'),"
                   " coalesce(CAST(amount AS VARCHAR), 'null'))")
    groups = f"{by}, " if by else ""
    return (
        f"SELECT {groups}count(*) AS n_rows, sum(CAST({h} AS DECIMAL(38,0))) AS hash_sum,"
        f" bit_xor({h}) AS hash_xor FROM {rows}" + (f" GROUP BY {by}" if by else "")
    )


_PRINT = "n_rows, CAST(hash_sum AS VARCHAR) AS hash_sum, CAST(hash_xor AS VARCHAR) AS hash_xor"


def compared(old: str, new: str) -> str:
    columns = ", ".join(
        f"{side}.n_rows AS {name}_n_rows, CAST({side}.hash_sum AS VARCHAR) AS {name}_hash_sum,"
        f" CAST({side}.hash_xor AS VARCHAR) AS {name}_hash_xor"
        for side, name in (("o", "old"), ("n", "new"))
    )
    return (
        f"SELECT {columns}, CASE WHEN o.n_rows = n.n_rows AND o.hash_sum = n.hash_sum"
        f" AND o.hash_xor = n.hash_xor THEN 'same' ELSE 'changed' END AS status"
        f" FROM ({fingerprint(old)}) o, ({fingerprint(new)}) n"
    )


_TXN = "txn_id, year, CAST(amount AS DOUBLE) AS amount, state, district, code, country_code"
_CLEAN = (
    "txn_id, CAST(year AS VARCHAR) AS year, CAST(amount AS DOUBLE) AS amount, state,"
    " CAST(district AS VARCHAR) AS district, code, country_code"
)
_PERSON = "firstname, lastname, typeofrep, party"
_DEMO = "state_name, population, CAST(median_household_income AS DOUBLE) AS median_household_income"
_SEAT = "c.state = l.state AND {d} = l.district AND c.year = l.year"


def _bare(alias: str = "c", code: str = "code") -> str:
    return (
        f"{alias}.txn_id, CAST({alias}.year AS VARCHAR) AS year, CAST({alias}.amount AS DOUBLE)"
        f" AS amount, {alias}.state, CAST({alias}.district AS VARCHAR) AS district,"
        f" {alias}.{code}, {alias}.country_code"
    )


def _top(rank: bool) -> str:
    wanted = (
        "firstname, lastname, description, party, district, state_name, year,"
        f" CAST({half_up(cents('amount'), '100000000', 2)} AS DOUBLE) / 100 AS amount_r,"
        f" CAST({half_up(cents('amount'), 'population * 100', 2)} AS DOUBLE) / 100 AS contract_pp,"
        f" CAST({half_up(cents('amount'), cents('med_hh_income'), 2)} AS DOUBLE) / 100"
        " AS contract_income"
    )
    order = "amount DESC, year, lastname, firstname"
    if not rank:
        return (
            f"SELECT {wanted} FROM (SELECT * FROM legis_hr WHERE description = 'Industry 07'"
            f" AND year > '1998' ORDER BY {order} LIMIT 15)"
        )
    return (
        f"SELECT rank, {wanted} FROM (SELECT *, row_number() OVER (PARTITION BY description"
        f" ORDER BY {order}) AS rank FROM legis_hr WHERE description <> 'None' AND year > '1998')"
        " WHERE rank <= 15"
    )


_KEYS = {
    "nation": "n_nationkey", "customer": "c_custkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_linenumber,l_orderkey,l_partkey,l_suppkey",
    "events": "event_id",
}


def _estimates() -> str:
    tables = [*_KEYS, "supplier"]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS approx_cnt FROM {t}" for t in tables
    )


def _planned(estimates: str) -> str:
    return f"""
  SELECT table_name, approx_cnt, upper_bound,
         CASE WHEN upper_bound > 1500 THEN CAST(round_even(upper_bound / 1000.0, 0) AS INT)
              ELSE 1 END AS n_chunks,
         CASE WHEN upper_bound > 1500 THEN 'append' ELSE 'error' END AS save_mode
    FROM (SELECT *, CAST(floor(CAST(approx_cnt AS DOUBLE) * CAST(1.10 AS DOUBLE)) AS BIGINT)
            AS upper_bound FROM ({estimates}))"""


def _listed_keys() -> str:
    rows = ", ".join(f"('{t}', '{k}')" for t, k in _KEYS.items() if t != "events")
    return f"(VALUES {rows}) AS k(table_name, pkey)"


_TERM = f"{_PERSON}, state, district, start_year, end_year"
_LEG_YEAR = f"{_PERSON}, state, district, year"


def statements() -> dict[str, str]:
    q = with_ctes
    raw_year = "SELECT DISTINCT action_date, {y} AS year FROM txn"
    day = "CAST('{}' AS VARCHAR) AS snapshot_date"
    sql = {
        "project_contracts": q("contracts_raw", f"SELECT {_TXN} FROM contracts_raw"),
        "project_grants": q(
            "grants_raw", f"SELECT {_TXN.replace('code,', 'industry,', 1)} FROM grants_raw"
        ),
        "stable_row_id": (
            "SELECT *, CAST(" + md5_number("txn_id") + " AS VARCHAR) AS row_id FROM"
            " (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
            " replace(CAST(CAST(l_extendedprice - 50000 AS DECIMAL(18,2)) AS VARCHAR),"
            " '-', '\\-')) AS txn_id FROM lineitem)"
        ),
        "dense_row_numbers": (
            "SELECT l_returnflag, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY"
            " l_returnflag ORDER BY l_orderkey, l_linenumber) - 1 AS row_no,"
            " count(*) OVER (PARTITION BY l_returnflag) AS n_rows FROM lineitem"
        ),
        "naics_labels_all": q("labels_all", "SELECT * FROM labels_all"),
        "naics_labels_4": q("labels_4", "SELECT * FROM labels_4"),
        "state_dim_2010": q("states", f"SELECT state, {_DEMO} FROM states"),
        "clean_year": q("txn", raw_year.format(y=year("action_date"))),
        "clean_year_strict": q(
            "txn",
            f"SELECT DISTINCT compact, {year('compact')} AS compat,"
            f" {year('compact', 'strict')} AS strict"
            " FROM (SELECT replace(action_date, '-', '') AS compact FROM txn)",
        ),
        "clean_district": q(
            "txn",
            "SELECT DISTINCT legal_entity_congressional AS label,"
            f" {district('legal_entity_congressional')} AS district FROM txn",
        ),
        "clean_country": q(
            "contracts_raw",
            f"SELECT state, {_COUNTRY} AS country_code, count(*) AS n_rows FROM contracts_raw"
            " GROUP BY ALL",
        ),
        "industry_prefix": q(
            "contracts_raw",
            "SELECT code, substr(code, 1, 4) AS industry, count(*) AS n_rows FROM contracts_raw"
            " GROUP BY ALL",
        ),
        "terms_flat": q("roster_terms", f"SELECT {_TERM} FROM roster_terms"),
        "legislator_years": q(
            "roster_terms", "SELECT * FROM (" + _years("roster_terms", "TRUE") + ")"
        ),
        "legislator_union": q("roster_years", f"SELECT {_LEG_YEAR} FROM roster_years"),
        **dict.fromkeys(
            ("legislator_json_scan", "legislator_json_split"),
            q("roster_terms", f"SELECT {_TERM} FROM roster_terms"),
        ),
        "label_preserving_join": q(
            "labels_all contracts_full",
            f"SELECT l.code, description, {_bare('c').replace('c.code, ', '')}"
            " FROM labels_all l LEFT JOIN contracts_full c ON l.code = c.code",
        ),
        "contracts_with_industry": q(
            "contracts labels_4",
            f"SELECT {_bare()}, description FROM contracts c LEFT JOIN labels_4 l"
            " ON c.code = l.code",
        ),
        "contracts_with_state": q(
            "contracts states",
            f"SELECT {_bare()}, {_DEMO} FROM contracts c LEFT JOIN states s ON c.state = s.state",
        ),
        "contracts_with_legislator": q(
            "contracts legislators",
            f"SELECT {_bare()}, {_PERSON} FROM contracts c LEFT JOIN legislators l ON "
            + _SEAT.format(d="c.district"),
        ),
        "grants_with_legislator": q(
            "grants legislators",
            f"SELECT {_bare('c', 'industry')}, {_PERSON} FROM (SELECT * REPLACE"
            f" ({number('district')} AS district) FROM grants) c LEFT JOIN legislators l ON "
            + _SEAT.format(d="c.district"),
        ),
        "contracts_with_senator": q(
            "contracts legislators",
            f"SELECT {_bare()}, {_PERSON} FROM contracts c LEFT JOIN"
            " (SELECT * FROM legislators WHERE typeofrep = 'sen') l"
            " ON c.state = l.state AND c.year = l.year",
        ),
        "govgrant_data": q(
            "grants legislators",
            f"SELECT {_bare('c', 'industry')}, {_PERSON} FROM grants c LEFT JOIN legislators l ON "
            + _SEAT.format(d=f"({number('c.district')})"),
        ),
        "govcontract_data": q(
            "labels_all contracts_full legislators",
            f"SELECT x.code, description, {_bare('x').replace('x.code, ', '')}, {_PERSON}"
            " FROM (SELECT l.code, description, c.* EXCLUDE (code)"
            "  FROM labels_all l LEFT JOIN contracts_full c ON l.code = c.code) x"
            " LEFT JOIN legislators l ON x.state = l.state AND x.district = l.district"
            " AND x.year = l.year",
        ),
        "govgrant_data_dedup": q(
            "grants legislators",
            f"SELECT * EXCLUDE (rno) FROM (SELECT DISTINCT rno, {_bare('c', 'industry')},"
            f" {_PERSON} FROM grants c LEFT JOIN legislators l ON "
            + _SEAT.format(d=f"({number('c.district')})")
            + ")",
        ),
        "enriched_distinct": q(
            "combined",
            f"SELECT {_CLEAN}, description, {_DEMO}, {_PERSON} FROM"
            " (SELECT DISTINCT * FROM combined WHERE typeofrep = 'rep')",
        ),
        "legis_by_year_hr": mart("legis", "rep"),
        "legis_by_year_sen": mart("legis", "sen"),
        "indus_by_year_hr": mart("indus", "rep"),
        "indus_by_year_sen": mart("indus", "sen"),
        "state_by_year_hr": mart("state", "rep"),
        "state_by_year_sen": mart("state", "rep"),
        "legis_by_year_sen_by_state": mart("legis", "sen", "combined_state"),
        "indus_by_year_sen_by_state": mart("indus", "sen", "combined_state"),
        "state_by_year_sen_by_state": mart("state", "sen", "combined_state"),
        "indus_by_year_roster": mart("indus", "rep", "combined_roster"),
        "mart_probe": mart("legis", "rep") + " ORDER BY year NULLS FIRST, firstname NULLS FIRST,"
        " lastname NULLS FIRST, description NULLS FIRST LIMIT 1",
        "mart_with_snapshot": mart("legis", "rep", "combined", ", " + day.format("2020-01-05")),
        "latest_snapshot": mart(
            "state", "rep", "combined_appended", ", " + day.format("2020-02-05")
        ),
        "refreshed_mart": mart("legis", "rep", "combined_appended"),
        "net_obligation": q(
            "contracts",
            "SELECT CAST(year AS VARCHAR) AS year, code, state, CAST(district AS VARCHAR)"
            " AS district, CAST(sum(amount) AS DOUBLE) AS net_amount, count(*) AS n_actions"
            " FROM contracts GROUP BY ALL",
        ),
        "totals_by_term": q(
            "contracts legislators",
            "SELECT state, CAST(district AS VARCHAR) AS district, CAST(year AS VARCHAR) AS year,"
            " firstname, lastname, typeofrep, party, CAST(amount AS DOUBLE) AS amount"
            " FROM legislators JOIN (SELECT state, district, year, sum(amount) AS amount"
            "  FROM contracts GROUP BY ALL) USING (state, district, year)",
        ),
        "overlap_report": q(
            "contracts legislators",
            "SELECT state, district, year, n_holders, CAST(amount AS DOUBLE) AS amount,"
            " CAST(amount * (n_holders - 1) AS DOUBLE) AS extra_amount FROM"
            " (SELECT state, district, year, count(DISTINCT firstname || ' ' || lastname)"
            "   AS n_holders FROM legislators WHERE typeofrep = 'rep' GROUP BY ALL)"
            " JOIN (SELECT state, district, year, sum(amount) AS amount FROM contracts"
            "  GROUP BY ALL) USING (state, district, year) WHERE n_holders > 1",
        ),
        "industry_list": q(
            "legis_hr", "SELECT DISTINCT description FROM legis_hr WHERE description != 'None'"
        ),
        "industry_party_series": q(
            "indus_hr",
            "SELECT year, party, description, CAST(sum(amount) AS DOUBLE) AS amount"
            " FROM indus_hr WHERE description = 'Industry 07' GROUP BY year, party, description",
        ),
        "industry_party_series_all": q(
            "indus_hr",
            "SELECT year, party, description, CAST(sum(amount) AS DOUBLE) AS amount"
            " FROM indus_hr GROUP BY year, party, description",
        ),
        "party_pivot": q(
            "indus_hr",
            "SELECT year, description,"
            " CAST(sum(amount) FILTER (party = 'Democrat') AS DOUBLE) AS democrat,"
            " CAST(sum(amount) FILTER (party = 'Republican') AS DOUBLE) AS republican"
            " FROM indus_hr WHERE party IN ('Democrat', 'Republican') GROUP BY year, description",
        ),
        "top_legislators": q("legis_hr", _top(rank=False)),
        "top_legislators_all": q("legis_hr", _top(rank=True)),
        "snapshot_diff": q(
            "snap_diff",
            "SELECT txn_id, CAST(old_amount AS DOUBLE) AS old_amount,"
            " CAST(new_amount AS DOUBLE) AS new_amount, status FROM snap_diff",
        ),
        "snapshot_new_rows": q(
            "snap_new snap_old",
            f"SELECT {_TXN} FROM snap_new WHERE txn_id NOT IN (SELECT txn_id FROM snap_old)",
        ),
        "snapshot_carryover": q("snap_kept", f"SELECT {_TXN} FROM snap_kept"),
        "snapshot_append": q("snap_appended", f"SELECT {_TXN} FROM snap_appended"),
        "snapshot_fingerprint": q(
            "snap_new", f"SELECT {_PRINT} FROM ({fingerprint('snap_new')})"
        ),
        "snapshot_compare": q("snap_old snap_kept", compared("snap_old", "snap_kept")),
        "fingerprint_by_group": q(
            "snap_new", f"SELECT state, code, {_PRINT} FROM ({fingerprint('snap_new', 'state, code')})"
        ),
        "refreshed_transactions": q("snap_appended", f"SELECT {_TXN} FROM snap_appended"),
        "copied_table": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate),"
        " l_orderkey % 7 AS chunk FROM lineitem",
        "appended_batches": q(
            "contracts_raw", "SELECT txn_id, CAST(amount AS DOUBLE) AS amount FROM contracts_raw"
        ),
        "copied_tables": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows,"
            f" (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns, 0 AS n_differing FROM {t}"
            for t in _KEYS if t != "events"
        ),
        "equal_depth_pieces": "SELECT count(*) AS n_rows, 8 AS n_pieces, true AS even FROM lineitem",
        "chunk_plan_from_footers": _planned(_estimates()),
        "chunk_assignment": q(
            "txn", f"SELECT txn_id, CAST({md5_number('txn_id')} % 100 + 1 AS INT) AS chunk FROM txn"
        ),
        "chunk_row_counts": q(
            "txn",
            f"SELECT CAST({md5_number('txn_id')} % 100 + 1 AS INT) AS chunk, count(*) AS n_rows"
            " FROM txn GROUP BY ALL",
        ),
        "chunk_plan": _planned(_estimates()),
        "migration_plan": (
            f"SELECT p.*, k.pkey FROM ({_planned(_estimates())}) p JOIN {_listed_keys()}"
            " ON k.table_name = p.table_name"
        ),
    }
    sql["localized_diff"] = sql["tree_diff"] = q(
        "local_diff",
        "SELECT txn_id, CAST(old_amount AS DOUBLE) AS old_amount,"
        " CAST(new_amount AS DOUBLE) AS new_amount, status FROM local_diff",
    )
    return sql
