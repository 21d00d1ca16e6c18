"""DuckDB oracle: for each query key, SQL over the driver's tables.

Written from the meaning of the models, in another form than the Spark side
or any model chain: both exports are one typed ledger; rules are a table that
each distinct description meets once; ranks are counts of larger groups, lags
are joins to the latest earlier month, shares and running totals are joins to
sums, and the two monthly sides meet in one grouped union. Money is summed as
DECIMAL(18,6), so that both engines add exactly.
"""

from __future__ import annotations

from tally.operators.rules import DEFAULT_RULE_GROUPS
from tally.plans.marts import INCOME_TYPE_RULES
from tally.sources.adapter import (
    BANK_CREDIT_INDEXES,
    BANK_DESCRIPTIONS,
    CARD_CREDIT_INDEXES,
    CARD_CREDIT_TYPE,
    CARD_DEBIT_TYPE,
    CARD_MERCHANTS,
)

START = "1996-01-01"
MID_MONTH_START = "1996-01-15"
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def _ints(values: list[int]) -> str:
    return ", ".join(str(v) for v in values)


def bank_export_sql() -> str:
    return f"""
    SELECT 'O' || o_orderkey AS transaction_id,
           cast(o_orderdate AS date) AS date,
           {_list(BANK_DESCRIPTIONS)}[o_orderkey % 20 + 1] AS description,
           cast(CASE WHEN o_orderkey % 20 IN ({_ints(BANK_CREDIT_INDEXES)})
                THEN 5 ELSE -1 END
                * (cast(o_totalprice AS decimal(18,2)) + (o_orderkey % 97) * 0.0001::decimal(18,4))
                AS decimal(18,4)) AS amount,
           CASE WHEN o_orderkey % 20 IN ({_ints(BANK_CREDIT_INDEXES)}) THEN 'credit' ELSE 'debit' END
             AS transaction_type
    FROM orders"""


def card_export_sql(with_category: bool = False) -> str:
    cat = ", nullif(p_type, 'STANDARD') AS merchant_category" if with_category else ""
    join = " JOIN part ON p_partkey = l_partkey" if with_category else ""
    return f"""
    SELECT 'L' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber
             AS transaction_id,
           cast(l_shipdate AS date) AS post_date,
           {_list(CARD_MERCHANTS)}[l_partkey % 16 + 1] AS merchant_name{cat},
           cast(CASE WHEN l_partkey % 16 IN ({_ints(CARD_CREDIT_INDEXES)})
                THEN -1 ELSE 1 END
                * (cast(l_extendedprice AS decimal(18,2)) + (l_orderkey % 89) * 0.0001::decimal(18,4))
                AS decimal(18,4)) AS amount,
           CASE WHEN l_partkey % 16 IN ({_ints(CARD_CREDIT_INDEXES)})
                THEN {q(CARD_CREDIT_TYPE)} ELSE {q(CARD_DEBIT_TYPE)} END AS transaction_type
    FROM lineitem{join}"""


def card_dirty_sql() -> str:
    return f"""
    SELECT 'L' || l_orderkey || '-' || l_linenumber AS transaction_id,
           CASE WHEN l_orderkey % 101 = 0 THEN 'not a date'
                ELSE cast(cast(l_shipdate AS date) AS varchar) END AS post_date,
           {_list(CARD_MERCHANTS)}[l_partkey % 16 + 1] AS merchant_name,
           CASE WHEN l_orderkey % 97 = 0 THEN NULL
                WHEN l_orderkey % 89 = 0 THEN NULL
                ELSE cast(cast(CASE WHEN l_partkey % 16 IN ({_ints(CARD_CREDIT_INDEXES)})
                     THEN -1 * cast(l_extendedprice AS decimal(18,2))
                     ELSE cast(l_extendedprice AS decimal(18,2)) END AS decimal(18,2)) AS varchar)
           END AS amount,
           CASE WHEN l_partkey % 16 IN ({_ints(CARD_CREDIT_INDEXES)})
                THEN {q(CARD_CREDIT_TYPE)} ELSE {q(CARD_DEBIT_TYPE)} END AS transaction_type
    FROM lineitem"""


def _standardised(export: str, date_col: str, desc_col: str, source: str, extra: str = "") -> str:
    return f"""
    SELECT trim(cast(transaction_id AS varchar), {WS}) AS transaction_id,
           try_cast({date_col} AS timestamp) AS date,
           upper(trim({desc_col}, {WS})) AS description,
           try_cast(amount AS double) AS amount,
           lower(trim(transaction_type, {WS})) AS transaction_type,
           '{source}' AS source{extra}
    FROM ({export})"""


def rule_values() -> str:
    """(priority, keyword, category) rows of the rule table."""
    flat = [(kw, category) for category, kws in DEFAULT_RULE_GROUPS for kw in kws]
    return ", ".join(f"({k}, {q(kw)}, {q(cat)})" for k, (kw, cat) in enumerate(flat, 1))


def income_values() -> str:
    """(priority, keyword, income type) rows."""
    return ", ".join(f"({k}, {q(kw)}, {q(label)})" for k, (label, kws) in enumerate(INCOME_TYPE_RULES, 1) for kw in kws)


def ledger_ctes(with_category: bool = False) -> str:
    """``led``: one typed row per usable export row; ``cat``: with its category."""
    provider = "merchant_category" if with_category else "NULL"
    return f"""
entry AS (
    SELECT 'bank' AS source, transaction_id, cast(date AS varchar) AS day, description AS words,
           cast(amount AS varchar) AS figure, transaction_type AS kind, NULL::varchar AS provider
    FROM ({bank_export_sql()})
    UNION ALL
    SELECT 'card', transaction_id, cast(post_date AS varchar), merchant_name, cast(amount AS varchar),
           transaction_type, {provider}::varchar
    FROM ({card_export_sql(with_category)})),
led AS (
    SELECT source, trim(transaction_id, {WS}) AS transaction_id,
           try_cast(day AS date) AS transaction_date,
           upper(trim(words, {WS})) AS description,
           provider AS provider_category,
           try_cast(figure AS double) * if(source = 'card', -1, 1) AS amount,
           if(source = 'card', try_cast(figure AS double) > 0, try_cast(figure AS double) < 0) AS is_debit,
           abs(try_cast(figure AS double)) AS absolute_amount,
           lower(trim(kind, {WS})) AS transaction_type
    FROM entry
    WHERE transaction_id IS NOT NULL AND try_cast(day AS date) IS NOT NULL
      AND try_cast(figure AS double) IS NOT NULL),
dated AS (
    SELECT led.*, concat(source, '-', transaction_id) AS unique_transaction_id,
           make_date(year(transaction_date), month(transaction_date), 1) AS transaction_month,
           make_date(year(transaction_date), 1, 1) AS transaction_year,
           month(transaction_date) AS month_number, year(transaction_date) AS year_number,
           dayofweek(transaction_date) AS day_of_week, quarter(transaction_date) AS quarter_number,
           strftime(transaction_date, '%b %Y') AS month_label,
           coalesce(contains(description, 'PAYMENT') AND source = 'card' AND transaction_type = 'credit', false)
             AS is_payment,
           coalesce(regexp_matches(description, 'TRANSFER|ZELLE|VENMO'), false) AS is_transfer
    FROM led),
texts AS (SELECT DISTINCT description FROM led),
rule(place, word, label) AS (VALUES {rule_values()}),
first_rule AS (
    SELECT description, arg_min(label, place) AS label
    FROM texts JOIN rule ON contains(description, word) GROUP BY description),
cat AS (
    SELECT dated.*,
           coalesce(nullif(nullif(provider_category, ''), 'Unknown'), label, 'Other') AS category,
           coalesce(nullif(nullif(provider_category, ''), 'Unknown'), label, 'Other') = 'Other' AS is_uncategorised
    FROM dated LEFT JOIN first_rule USING (description)),
income_word(place, word, label) AS (VALUES {income_values()}),
income_text AS (
    SELECT description, arg_min(label, place) AS income_label
    FROM texts JOIN income_word ON contains(description, word) GROUP BY description),
typed AS (
    SELECT cat.*, coalesce(income_label, 'Other income') AS income_type
    FROM cat LEFT JOIN income_text USING (description))"""


def calendar(month: str = "g.transaction_month") -> str:
    """The calendar columns of a month."""
    return (f"{month} AS transaction_month, strftime({month}, '%b %Y') AS month_label, "
            f"year({month}) AS year_number, month({month}) AS month_number, quarter({month}) AS quarter_number")


def group_ctes(name: str, dim: str, condition: str) -> str:
    """``<name>_rows``, ``<name>_g`` (grouped) and ``<name>_x`` (with the previous month's and the month's total)."""
    return f"""
{name}_rows AS (SELECT * FROM typed WHERE {condition}),
{name}_g AS (
    SELECT transaction_month, {dim}, source, sum(absolute_amount::decimal(18,6)) AS total,
           count(*) AS n, min(absolute_amount) AS least, max(absolute_amount) AS most
    FROM {name}_rows GROUP BY ALL),
{name}_before AS (
    SELECT g.transaction_month, g.{dim}, g.source, max(p.transaction_month) AS earlier
    FROM {name}_g g JOIN {name}_g p
      ON p.{dim} = g.{dim} AND p.source = g.source AND p.transaction_month < g.transaction_month
    GROUP BY ALL),
{name}_month AS (SELECT transaction_month, sum(total) AS month_total FROM {name}_g GROUP BY 1),
{name}_x AS (
    SELECT g.*, m.month_total, p.total AS previous
    FROM {name}_g g JOIN {name}_month m USING (transaction_month)
    LEFT JOIN {name}_before b
      ON b.transaction_month = g.transaction_month AND b.{dim} = g.{dim} AND b.source = g.source
    LEFT JOIN {name}_g p
      ON p.transaction_month = b.earlier AND p.{dim} = g.{dim} AND p.source = g.source)"""


def spend_ctes(start: str = START) -> str:
    where = (f"is_debit AND NOT (is_payment OR is_transfer) AND category <> 'Income' "
             f"AND transaction_date >= DATE '{start}'")
    return group_ctes("spend", "category", where) + f""",
mart_monthly_spend AS (
    SELECT {calendar()}, g.category, g.source,
           round(g.total::double, 2) AS total_spend, g.n AS transaction_count,
           round(g.total::double / g.n, 2) AS avg_transaction_amount,
           round(g.least, 2) AS min_transaction_amount, round(g.most, 2) AS max_transaction_amount,
           (SELECT count(*) + 1 FROM spend_g o
            WHERE o.transaction_month = g.transaction_month AND o.total > g.total) AS category_spend_rank,
           coalesce(round((g.total - g.previous)::double, 2), 0) AS mom_spend_change,
           round(g.total::double / nullif(g.month_total::double, 0) * 100, 2) AS pct_of_monthly_spend
    FROM spend_x g)"""


def income_ctes(start: str = START) -> str:
    where = f"NOT (is_debit OR is_transfer OR is_payment) AND transaction_date >= DATE '{start}'"
    return group_ctes("income", "income_type", where) + f""",
mart_income AS (
    SELECT {calendar()}, g.income_type, g.source,
           round(g.total::double, 2) AS total_income, g.n AS transaction_count,
           round(g.total::double / g.n, 2) AS avg_transaction_amount,
           round(g.most, 2) AS largest_transaction_amount,
           coalesce(round((g.total - g.previous)::double, 2), 0) AS mom_income_change,
           round(g.month_total::double, 2) AS total_monthly_income,
           round(g.total::double / nullif(g.month_total::double, 0) * 100, 2) AS pct_of_monthly_income
    FROM income_x g)"""


def savings_ctes(start: str = START) -> str:
    return f"""
sides AS (
    SELECT transaction_month, total_income::decimal(18,2) AS i, 0 AS s, transaction_count AS ni, 0 AS ns
    FROM mart_income
    UNION ALL
    SELECT transaction_month, 0, total_spend::decimal(18,2), 0, transaction_count FROM mart_monthly_spend),
months AS (
    SELECT transaction_month, sum(i) AS i, sum(s) AS s, sum(ni)::bigint AS ni, sum(ns)::bigint AS ns
    FROM sides GROUP BY 1),
kept AS (
    SELECT *, i - s AS net, (i - s)::double / nullif(i::double, 0) AS ratio FROM months
    WHERE transaction_month >= DATE '{start}'),
run AS (
    SELECT k.transaction_month, sum(e.net) AS so_far, max(if(e.transaction_month < k.transaction_month,
           e.transaction_month, NULL)) AS earlier
    FROM kept k JOIN kept e ON e.transaction_month <= k.transaction_month GROUP BY 1),
mart_savings_rate AS (
    SELECT k.transaction_month,
           if(k.ni > 0, strftime(k.transaction_month, '%b %Y'), 'Unknown') AS month_label,
           if(k.ni > 0, year(k.transaction_month), 0) AS year_number,
           if(k.ni > 0, month(k.transaction_month), 0) AS month_number,
           if(k.ni > 0, quarter(k.transaction_month), 0) AS quarter_number,
           k.i::double AS total_income, k.s::double AS total_spend, k.net::double AS net_savings,
           round(k.ratio * 100, 2) AS savings_rate,
           round(k.s::double / nullif(k.i::double, 0) * 100, 2) AS spending_rate,
           round(p.ratio * 100, 2) AS prior_month_savings_rate,
           r.so_far::double AS cumulative_savings,
           (k.i - p.i)::double AS mom_income_change, (k.s - p.s)::double AS mom_spend_change,
           k.net >= 0 AS is_surplus_month,
           coalesce((SELECT label FROM (VALUES (0.20, 'Healthy'), (0.05, 'On track'), (0.0, 'Tight'),
                                               (-1e308, 'Deficit')) band(bound, label)
                     WHERE k.ratio >= bound ORDER BY bound DESC LIMIT 1), 'No income data')
             AS financial_health_status,
           k.ni AS income_transaction_count, k.ns AS spend_transaction_count,
           k.ni + k.ns AS total_transaction_count
    FROM kept k JOIN run r USING (transaction_month) LEFT JOIN kept p ON p.transaction_month = r.earlier)"""


def joined_select() -> str:
    """Both monthly sides side by side (before the month filter)."""
    return """SELECT transaction_month,
       if(ni > 0, strftime(transaction_month, '%b %Y'), 'Unknown') AS month_label,
       if(ni > 0, year(transaction_month), 0) AS year_number,
       if(ni > 0, month(transaction_month), 0) AS month_number,
       if(ni > 0, quarter(transaction_month), 0) AS quarter_number,
       i::double AS total_income, s::double AS total_spend,
       ni AS income_transaction_count, ns AS spend_transaction_count FROM months"""


def stats_ctes() -> str:
    return """
per_month AS (
    SELECT transaction_month AS month, category, sum(amount::decimal(18,6)) AS total, count(*) AS n
    FROM cat WHERE transaction_type = 'debit' GROUP BY ALL),
spread AS (
    SELECT category, sum(total)::double / count(*) AS mean, quantile_cont(total::double, 0.5) AS middle,
           stddev_samp(total::double) AS sd, min(total)::double AS low, max(total)::double AS high,
           sum(n)::bigint AS rows, avg(total::double / n) AS size
    FROM per_month GROUP BY category),
mart_spending_stats AS (
    SELECT category, round(mean, 2) AS mean_monthly_spend, round(middle, 2) AS median_monthly_spend,
           round(sd, 2) AS stddev_monthly_spend, round(low, 2) AS min_monthly_spend,
           round(high, 2) AS max_monthly_spend, round(high - low, 2) AS spend_range,
           round(sd / nullif(mean, 0), 4) AS coefficient_of_variation,
           rows AS total_transactions, round(size, 2) AS avg_transaction_size
    FROM spread)"""


# --------------------------------------------------------------------------
# data-quality oracle
# --------------------------------------------------------------------------

DQ_AS_OF = "2000-01-01"
BANK_COLS = {"id": "transaction_id", "date": "date", "desc": "description", "amount": "amount",
             "type": "transaction_type",
             "non_null": ["transaction_id", "date", "description", "amount", "transaction_type"]}
CARD_COLS = {"id": "transaction_id", "date": "post_date", "desc": "merchant_name", "amount": "amount",
             "type": "transaction_type",
             "non_null": ["transaction_id", "post_date", "merchant_name", "amount", "transaction_type"]}


def _text(export: str) -> str:
    """Every column as text (what a CSV read yields)."""
    return f"SELECT * REPLACE (cast(amount AS varchar) AS amount) FROM ({export})"


def bank_text_sql() -> str:
    return f"SELECT transaction_id, cast(date AS varchar) AS date, description, amount, transaction_type FROM ({_text(bank_export_sql())})"


def dq_rows_sql(source: str, rel: str, cols: dict) -> str:
    """One row per check: source, check, severity, column, n_bad."""
    d = f"try_cast({cols['date']} AS timestamp)"
    a = f"try_cast({cols['amount']} AS double)"
    t = f"coalesce(lower(trim({cols['type']}, {WS})), 'nan')"
    items = [("rows_read", "info", None, "count(*)"),
             ("row_count_min", "error", None, "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END"),
             ("row_count_max", "warning", None, "greatest(count(*) - 100000, 0)")]
    for c in cols["non_null"]:
        items.append(("nulls", "error", c, f"count(*) FILTER (WHERE {c} IS NULL)"))
    items += [
        ("unparseable_dates", "error", cols["date"], f"count(*) FILTER (WHERE {d} IS NULL)"),
        ("future_dates", "warning", cols["date"], f"count(*) FILTER (WHERE {d} > TIMESTAMP '{DQ_AS_OF}')"),
        ("non_numeric_amounts", "error", cols["amount"], f"count(*) FILTER (WHERE {a} IS NULL)"),
        ("amount_out_of_bounds", "warning", cols["amount"],
         f"count(*) FILTER (WHERE {a} < -50000.0 OR {a} > 50000.0)"),
        ("zero_amounts", "warning", cols["amount"], f"count(*) FILTER (WHERE {a} = 0)"),
        ("invalid_transaction_types", "error", cols["type"],
         f"count(*) FILTER (WHERE {t} NOT IN ('credit', 'debit'))"),
    ]
    parts = []
    for check, sev, col, expr in items:
        colsql = "NULL::varchar" if col is None else q(col)
        parts.append(f"SELECT '{source}' AS source, '{check}' AS \"check\", '{sev}' AS severity, "
                     f"{colsql} AS \"column\", cast({expr} AS bigint) AS n_bad FROM ({rel})")
    parts.append(f"""SELECT '{source}' AS source, 'duplicate_ids' AS "check", 'error' AS severity,
       '{cols['id']}' AS "column",
       cast(coalesce((SELECT sum(n - 1) FROM (SELECT {cols['id']}, count(*) AS n FROM ({rel})
                     GROUP BY {cols['id']}) WHERE n > 1), 0) AS bigint) AS n_bad""")
    return "\nUNION ALL\n".join(parts)


def dq_all_sql() -> str:
    return (dq_rows_sql("bank", bank_text_sql(), BANK_COLS) + "\nUNION ALL\n"
            + dq_rows_sql("card", card_dirty_sql(), CARD_COLS))


def dq_filter(checks: list[str]) -> str:
    names = ", ".join(q(c) for c in checks)
    return f'SELECT source, "check", severity, "column", n_bad FROM ({dq_all_sql()}) WHERE "check" IN ({names})'


def dq_samples_sql(source: str, rel: str, cols: dict) -> str:
    d = f"try_cast({cols['date']} AS timestamp)"
    a = f"try_cast({cols['amount']} AS double)"
    t = f"coalesce(lower(trim({cols['type']}, {WS})), 'nan')"
    ident = f"cast({cols['id']} AS varchar)"
    preds = [("nulls", c, f"{c} IS NULL") for c in cols["non_null"]]
    preds += [("unparseable_dates", cols["date"], f"{d} IS NULL"),
              ("future_dates", cols["date"], f"{d} > TIMESTAMP '{DQ_AS_OF}'"),
              ("non_numeric_amounts", cols["amount"], f"{a} IS NULL"),
              ("amount_out_of_bounds", cols["amount"], f"({a} < -50000.0 OR {a} > 50000.0)"),
              ("zero_amounts", cols["amount"], f"{a} = 0")]
    parts = []
    for check, col, pred in preds:
        parts.append(f"SELECT '{check}' AS \"check\", '{col}' AS \"column\", v FROM "
                     f"(SELECT {ident} AS v FROM ({rel}) WHERE {pred} AND {ident} IS NOT NULL ORDER BY v LIMIT 5)")
    parts.append(f"SELECT 'invalid_transaction_types' AS \"check\", '{cols['type']}' AS \"column\", v FROM "
                 f"(SELECT DISTINCT {t} AS v FROM ({rel}) WHERE {t} NOT IN ('credit', 'debit') ORDER BY v LIMIT 5)")
    parts.append(f"SELECT 'duplicate_ids' AS \"check\", '{cols['id']}' AS \"column\", v FROM "
                 f"(SELECT {ident} AS v FROM ({rel}) WHERE {ident} IS NOT NULL GROUP BY 1 HAVING count(*) > 1 "
                 f"ORDER BY v LIMIT 5)")
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT '{source}' AS source, \"check\", \"column\", string_agg(v, ',' ORDER BY v) AS sample "
            f"FROM ({body}) GROUP BY \"check\", \"column\"")


def dq_report_sql() -> str:
    return f"""
WITH r AS ({dq_all_sql()}),
per AS (
    SELECT source,
           cast(count(*) FILTER (WHERE n_bad > 0 AND severity = 'error') AS bigint) AS errors,
           cast(count(*) FILTER (WHERE n_bad > 0 AND severity = 'warning') AS bigint) AS warnings,
           cast(max(n_bad) FILTER (WHERE "check" = 'rows_read') AS bigint) AS rows
    FROM r GROUP BY source)
SELECT source, errors = 0 AS passed, rows, errors, warnings FROM per
UNION ALL
SELECT 'ALL', bool_and(errors = 0), cast(sum(rows) AS bigint), cast(sum(errors) AS bigint),
       cast(sum(warnings) AS bigint) FROM per"""


def gate_sql(source: str, rel: str) -> str:
    return f"""
SELECT '{source}' AS source, cast(sum(n) AS bigint) AS rows, cast(sum(nd) AS bigint) AS null_dates,
       cast(sum(na) AS bigint) AS null_amounts,
       cast(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS bigint) AS duplicate_ids,
       coalesce(sum(n), 0) > 0 AND coalesce(sum(nd), 0) = 0 AND coalesce(sum(na), 0) = 0
         AND coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) = 0 AS passed
FROM (SELECT transaction_id, count(*) AS n,
             count(*) FILTER (WHERE date IS NULL) AS nd,
             count(*) FILTER (WHERE amount IS NULL) AS na
      FROM ({rel}) GROUP BY transaction_id)"""


def std_bank() -> str:
    return _standardised(bank_export_sql(), "date", "description", "bank")


def std_card() -> str:
    return _standardised(card_export_sql(), "post_date", "merchant_name", "card")


def std_card_dirty() -> str:
    return _standardised(card_dirty_sql(), "post_date", "merchant_name", "card")


def dup_free(export: str) -> str:
    return f"(SELECT count(*) > 0 AND count(*) = count(DISTINCT transaction_id) FROM ({export}))"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


LEDGER_COLS = """unique_transaction_id, transaction_id, transaction_date, description,
       provider_category, amount, is_debit, absolute_amount, transaction_type, source,
       transaction_month, transaction_year, month_number, year_number, day_of_week,
       quarter_number, month_label, is_payment, is_transfer"""


def oracle_queries() -> dict[str, str]:
    base = ledger_ctes()
    sp, inc, sav, st = spend_ctes(), income_ctes(), savings_ctes(), stats_ctes()
    out = {
        "stg_bank": with_(base) + """
SELECT transaction_id, transaction_date, description, amount, is_debit, absolute_amount,
       transaction_type, source FROM led WHERE source = 'bank'""",
        "stg_card": with_(base) + """
SELECT transaction_id, transaction_date, description, provider_category, amount, is_debit,
       absolute_amount, transaction_type, source FROM led WHERE source = 'card'""",
        "int_all_transactions": with_(base) + f"\nSELECT {LEDGER_COLS} FROM dated",
        "int_categorized": with_(base) + f"\nSELECT {LEDGER_COLS}, category, is_uncategorised FROM typed",
        "mart_monthly_spend": with_(base, sp) + "\nSELECT * FROM mart_monthly_spend",
        "mart_income": with_(base, inc) + "\nSELECT * FROM mart_income",
        "mart_savings_rate": with_(base, sp, inc, sav) + "\nSELECT * FROM mart_savings_rate",
        "mart_spending_stats": with_(base, st) + "\nSELECT * FROM mart_spending_stats",
    }
    out.update(operator_queries())
    return out


def operator_queries() -> dict[str, str]:
    base = ledger_ctes()
    sp, inc, sav, st = spend_ctes(), income_ctes(), savings_ctes(), stats_ctes()
    spend_keys = "transaction_month, category, source"
    income_keys = "transaction_month, income_type, source"
    cat_cols = "unique_transaction_id, description, provider_category, category, is_uncategorised"
    raw_cols = "transaction_id, date, description, amount, transaction_type, source"
    stored_all = f"SELECT {raw_cols} FROM ({std_bank()}) UNION ALL SELECT {raw_cols} FROM ({std_card()})"
    mid = MID_MONTH_START
    out = {
        # sources and sinks
        "read_bank": f"""SELECT transaction_id, cast(date AS varchar) AS date, '"Q", ' || description || ' "x" \\' AS description,
            cast(amount AS varchar) AS amount, transaction_type, 'bank' AS source FROM ({bank_export_sql()})""",
        "read_card": f"""SELECT transaction_id, cast(post_date AS varchar) AS date,
            '"Q", ' || merchant_name || ' "x" \\' AS description, cast(amount AS varchar) AS amount, transaction_type, 'card' AS source
            FROM ({card_export_sql(with_category=True)})""",
        "dq_file_ready": """
            SELECT 'bank' AS source, if(count(*) > 0, 'ready', 'empty') AS status, count(*) AS n_rows FROM orders
            UNION ALL SELECT 'card', if(count(*) > 0, 'ready', 'empty'), count(*) FROM lineitem
            UNION ALL SELECT 'empty', 'empty', 0 UNION ALL SELECT 'missing', 'missing', 0""",
        "standardise": stored_all,
        "load_full": stored_all,
        "load_incremental": f"""
            SELECT transaction_id, date,
                   CASE WHEN o_key % 10 = 0 THEN description || ' (REVISED)' ELSE description END AS description,
                   amount, transaction_type, source
            FROM (SELECT *, cast(substr(transaction_id, 2) AS bigint) AS o_key FROM ({std_bank()}))
            UNION ALL
            SELECT transaction_id, date,
                   CASE WHEN o_key % 10 = 0 THEN description || ' (REVISED)' ELSE description END,
                   amount, transaction_type, source
            FROM (SELECT *, cast(substr(split_part(transaction_id, '-', 1), 2) AS bigint) AS o_key
                  FROM ({std_card()}))""",
        "load_outcome": f"""
            SELECT 'bank' AS source, CASE WHEN {dup_free(bank_export_sql())} THEN 'loaded' ELSE 'failed' END AS status,
                   CASE WHEN {dup_free(bank_export_sql())} THEN (SELECT count(*) FROM orders) ELSE 0 END AS rows_loaded
            UNION ALL
            SELECT 'card', CASE WHEN {dup_free(card_export_sql())} THEN 'loaded' ELSE 'failed' END,
                   CASE WHEN {dup_free(card_export_sql())} THEN (SELECT count(*) FROM lineitem) ELSE 0 END""",
        "mart_roundtrip": with_(base, sp) + "\nSELECT * FROM mart_monthly_spend",
        "load_stream": "\nUNION ALL\n".join(
            f"SELECT {raw_cols} FROM ({std}) WHERE {late} AND {dup_free(f'SELECT * FROM ({export}) WHERE {late}')}"
            for std, export in ((std_bank(), bank_export_sql()), (std_card(), card_export_sql()))
            for late in ("right(transaction_id, 1) IN ('0', '3', '6', '9')",
                         "right(transaction_id, 1) NOT IN ('0', '3', '6', '9')")),
        "load_race": stored_all,
        "raw_since": f"SELECT * FROM ({stored_all}) WHERE date IS NULL OR date >= date_trunc('month', DATE '{MID_MONTH_START}')",
        "view_models": with_(base) + """
SELECT 'int_categorized' AS model, source, category, count(*) AS n, count(*) FILTER (WHERE is_payment) AS payments
FROM typed GROUP BY source, category
UNION ALL SELECT 'int_all_transactions', source, NULL, count(*), count(*) FILTER (WHERE is_payment) FROM dated GROUP BY source
UNION ALL SELECT 'stg_' || source || '_txns', source, NULL, count(*), NULL FROM led GROUP BY source""",
        "audit_time": with_(base) + """
SELECT source, count(*) AS rows, 0::bigint AS without_time, true AS one_time, true AS not_before_the_query,
       true AS not_after_the_query FROM led GROUP BY source""",
        # projections, filters, classification
        "union_ledger": with_(base) + """
SELECT transaction_id, transaction_date, description, amount, is_debit, absolute_amount,
       transaction_type, provider_category, source FROM led""",
        "categorize": with_(base) + f"\nSELECT {cat_cols} FROM typed",
        "categorize_rules": with_(base) + f"\nSELECT {cat_cols} FROM typed",
        "categorize_provider": with_(ledger_ctes(with_category=True)) + f"\nSELECT {cat_cols} FROM typed",
        "spend_rows": with_(base, sp) + """
SELECT unique_transaction_id, transaction_date, category, source, absolute_amount FROM spend_rows""",
        "income_rows": with_(base, inc) + """
SELECT unique_transaction_id, transaction_date, income_type, source, absolute_amount FROM income_rows""",
        "income_type": with_(base) + f"""
SELECT unique_transaction_id, description, income_type FROM typed WHERE NOT is_debit""",
        "flag_payment": with_(base) + """
SELECT unique_transaction_id, source, transaction_type, description, is_payment FROM dated""",
        "flag_transfer": with_(base) + "\nSELECT unique_transaction_id, description, is_transfer FROM dated",
        "uncategorised_rate": with_(base) + """
SELECT transaction_month, count(*) AS transactions,
       count(*) FILTER (WHERE is_uncategorised) AS uncategorised,
       round(cast(count(*) FILTER (WHERE is_uncategorised) AS double) / count(*), 4) AS uncategorised_rate
FROM typed GROUP BY transaction_month""",
        "financial_health": with_(base, sp, inc, sav) + """
SELECT transaction_month, total_income, total_spend, is_surplus_month, financial_health_status
FROM mart_savings_rate""",
        "mart_savings_midmonth": with_(base, spend_ctes(mid), income_ctes(mid), savings_ctes(mid))
            + "\nSELECT * FROM mart_savings_rate",
        # joins
        "join_self_left": with_(base)
            # The join meets itself on a numbered id: the ledger is worked out once.
            + """, own AS MATERIALIZED (
    SELECT unique_transaction_id, description, category, dense_rank() OVER (ORDER BY unique_transaction_id) AS k FROM cat)
SELECT a.unique_transaction_id, a.description, b.category FROM own a LEFT JOIN own b ON a.k = b.k""",
        "join_full_outer": with_(base, sp, inc, sav) + """
""" + joined_select(),
        # aggregates
        "agg_spend": with_(base, sp) + f"""
SELECT {calendar()}, category, source, round(total::double, 2) AS total_spend, n AS transaction_count,
       round(total::double / n, 2) AS avg_transaction_amount,
       round(least, 2) AS min_transaction_amount, round(most, 2) AS max_transaction_amount
FROM spend_g g""",
        "agg_income": with_(base, inc) + f"""
SELECT {calendar()}, income_type, source, round(total::double, 2) AS total_income, n AS transaction_count,
       round(total::double / n, 2) AS avg_transaction_amount, round(most, 2) AS largest_transaction_amount
FROM income_g g""",
        "rollup_income_month": with_(base, sp, inc, sav) + f"""
SELECT {calendar()}, i::double AS total_income, ni AS income_transaction_count FROM months g WHERE ni > 0""",
        "rollup_spend_month": with_(base, sp, inc, sav) + """
SELECT transaction_month, s::double AS total_spend, ns AS spend_transaction_count FROM months WHERE ns > 0""",
        "agg_month_category": with_(base, st) + """
SELECT month, category, total::double AS total_spend, n AS transaction_count, total::double / n AS avg_transaction
FROM per_month""",
        "agg_median": with_(base, st) + "\nSELECT category, median_monthly_spend FROM mart_spending_stats",
        "agg_stddev": with_(base, st) + """
SELECT category, round(sd, 2) AS stddev_monthly_spend,
       (SELECT count(*) FROM per_month m WHERE m.category = spread.category) AS n_months FROM spread""",
        # windows, sort/limit
        "win_rank": with_(base, sp) + f"\nSELECT {spend_keys}, total_spend, category_spend_rank FROM mart_monthly_spend",
        "win_lag_spend": with_(base, sp) + f"\nSELECT {spend_keys}, total_spend, mom_spend_change FROM mart_monthly_spend",
        "win_share_spend": with_(base, sp) + f"\nSELECT {spend_keys}, pct_of_monthly_spend FROM mart_monthly_spend",
        "win_lag_income": with_(base, inc) + f"\nSELECT {income_keys}, total_income, mom_income_change FROM mart_income",
        "win_share_income": with_(base, inc)
            + f"\nSELECT {income_keys}, total_monthly_income, pct_of_monthly_income FROM mart_income",
        "win_cumulative": with_(base, sp, inc, sav)
            + "\nSELECT transaction_month, net_savings, cumulative_savings FROM mart_savings_rate",
        "win_lag_global": with_(base, sp, inc, sav) + """
SELECT transaction_month, mom_income_change, mom_spend_change, prior_month_savings_rate FROM mart_savings_rate""",
        "top_n_categories": with_(base, sp) + f"""
SELECT {spend_keys}, total_spend, category_spend_rank FROM mart_monthly_spend WHERE category_spend_rank <= 3""",
        # scalar functions
        "scalar_calendar": with_(base) + """
SELECT unique_transaction_id, transaction_date, transaction_month, transaction_year, month_number,
       year_number, day_of_week, quarter_number, month_label FROM dated""",
        "scalar_clean": f"""
SELECT cast(transaction_id AS varchar) AS transaction_id, merchant_name,
       upper(trim(merchant_name, {WS})) AS description,
       lower(trim(transaction_type, {WS})) AS transaction_type,
       'card-' || transaction_id AS unique_transaction_id,
       upper(trim(merchant_name, {WS})) ILIKE '%PAYMENT%' AS mentions_payment
FROM ({card_export_sql()})""",
        "scalar_amount": f"""
SELECT transaction_id, amount AS amount_text, try_cast(amount AS double) AS amount,
       try_cast(amount AS double) * -1 AS flipped, abs(try_cast(amount AS double)) AS absolute_amount,
       round(try_cast(amount AS double) / 3.0, 2) AS third_rounded,
       round(try_cast(amount AS double) / 7.0, 4) AS seventh_rounded
FROM ({card_dirty_sql()})""",
        "scalar_guarded_ratio": with_(base, sp, inc, sav) + """
SELECT transaction_month, i::double AS total_income, s::double AS total_spend,
       round(s::double / nullif(i::double, 0) * 100, 2) AS spending_rate,
       coalesce(round(s::double / nullif(i::double, 0) * 100, 2), 0) AS spending_rate_or_zero,
       i::double - s::double AS difference
FROM months""",
        # data quality
        "dq_columns": """
SELECT 'bank' AS source, 'required_columns' AS "check", 'error' AS severity, 'description' AS "column", 1::bigint AS n_bad
UNION ALL SELECT 'card', 'required_columns', 'error', NULL, 0
UNION ALL SELECT 'card', 'extra_columns', 'warning', 'merchant_category', 1
UNION ALL SELECT 'card', 'rows_read', 'info', NULL, count(*) FROM lineitem JOIN part ON p_partkey = l_partkey
UNION ALL SELECT 'card', 'malformed_rows', 'error', NULL, 0
UNION ALL SELECT 'loan', 'known_source', 'error', NULL, 1
UNION ALL SELECT 'card', 'file_ready', 'error', NULL, 1""",
        "dq_row_count": dq_filter(["rows_read", "row_count_min", "row_count_max"]),
        "dq_duplicates": dq_filter(["duplicate_ids"]),
        "dq_nulls": dq_filter(["nulls"]),
        "dq_dates": dq_filter(["unparseable_dates", "future_dates"]),
        "dq_amounts": dq_filter(["non_numeric_amounts", "amount_out_of_bounds", "zero_amounts"]),
        "dq_types": f"""
SELECT 'bank' AS source, coalesce(lower(trim(transaction_type, {WS})), 'nan') AS transaction_type,
       count(*) AS n, coalesce(lower(trim(transaction_type, {WS})), 'nan') IN ('credit', 'debit') AS is_valid
FROM ({bank_text_sql()}) GROUP BY 2
UNION ALL
SELECT 'card', coalesce(lower(trim(transaction_type, {WS})), 'nan'), count(*),
       coalesce(lower(trim(transaction_type, {WS})), 'nan') IN ('credit', 'debit')
FROM ({card_dirty_sql()}) GROUP BY 2""",
        "dq_samples": dq_samples_sql("bank", bank_text_sql(), BANK_COLS) + "\nUNION ALL\n"
            + dq_samples_sql("card", card_dirty_sql(), CARD_COLS),
        "dq_report": dq_report_sql(),
        "dq_load_gate": gate_sql("bank", std_bank()) + "\nUNION ALL\n" + gate_sql("card", std_card())
            + "\nUNION ALL\n" + gate_sql("card_dirty", std_card_dirty()),
        "dq_rejects": f"""
SELECT 'bank' AS source, count(*) AS rows,
       count(*) FILTER (WHERE transaction_id IS NULL OR date IS NULL OR amount IS NULL) AS rejected
FROM ({std_bank()})
UNION ALL
SELECT 'card_dirty', count(*),
       count(*) FILTER (WHERE transaction_id IS NULL OR date IS NULL OR amount IS NULL)
FROM ({std_card_dirty()})""",
        "test_not_null": with_(base, st) + """
SELECT 'mart_spending_stats' AS model, 'not_null' AS test, 'category' AS "column",
       count(*) FILTER (WHERE category IS NULL) AS failures,
       count(*) FILTER (WHERE category IS NULL) = 0 AS passed FROM mart_spending_stats
UNION ALL
SELECT 'mart_spending_stats', 'not_null', 'mean_monthly_spend',
       count(*) FILTER (WHERE mean_monthly_spend IS NULL),
       count(*) FILTER (WHERE mean_monthly_spend IS NULL) = 0 FROM mart_spending_stats""",
        "test_unique": with_(base, st) + """
SELECT 'mart_spending_stats' AS model, 'unique' AS test, 'category' AS "column",
       count(*) AS failures, count(*) = 0 AS passed
FROM (SELECT category FROM mart_spending_stats GROUP BY category HAVING count(*) > 1)""",
    }
    # The same stored rows, whatever the way in which new ids are found.
    out["load_screened"] = out["load_incremental"]
    return out
