"""The registered queries in DuckDB SQL, written from their definitions rather than their plans."""

from __future__ import annotations

from tidemark import schemas as S

TRADES = """
trades AS (
    SELECT l_suppkey::VARCHAR AS symbol,
           date_diff('day', DATE '1995-01-02', l_shipdate::DATE) // 7 AS bar_no,
           l_extendedprice / l_quantity AS price,
           l_extendedprice::DECIMAL(18, 2) AS usd,
           l_quantity::BIGINT AS coins,
           l_returnflag = 'N' AS buys,
           l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice
    FROM lineitem
)"""

RANK = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice"

BARS = f"""{TRADES},
sums AS (
    SELECT symbol, bar_no,
           first(price ORDER BY {RANK}) AS open,
           max(price) AS high,
           min(price) AS low,
           last(price ORDER BY {RANK}) AS close,
           sum(usd)::DOUBLE AS usd,
           sum(coins)::DOUBLE AS coins,
           coalesce(sum(coins) FILTER (WHERE buys), 0)::DOUBLE AS buy_coins,
           coalesce(sum(usd) FILTER (WHERE NOT buys), 0)::DOUBLE AS sell_usd,
           count(*)::BIGINT AS n
    FROM trades GROUP BY symbol, bar_no
),
bars AS (
    SELECT *, bar_no // 52 AS part,
           TIMESTAMP '1995-01-02' + to_days((bar_no * 7)::INTEGER) AS time_open,
           DATE '1995-01-02' + (bar_no // 52 * 364)::INTEGER AS date,
           CASE WHEN usd * coins <> 0 THEN usd / coins ELSE 0 END AS avg
    FROM sums
)"""

BAR_COLUMNS = f"""symbol, time_open, date,
    open AS {S.OPEN}, high AS {S.HIGH}, low AS {S.LOW}, close AS {S.CLOSE},
    usd AS {S.USD}, coins AS {S.COINS}, buy_coins AS {S.TAKER_BUY_COINS},
    sell_usd AS {S.TAKER_SELL_USD}, n AS {S.TRANSACTIONS}"""

# Windows run over whole symbols here.
LOOKBACK = f"""{BARS},
looked AS (
    SELECT *, coalesce(lag(bar_no, 10) OVER w = bar_no - 10, false) AS is_full
    FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_no)
)"""


def _grown(earlier: str) -> str:
    ratio = f"(usd / nullif(coins, 0)) / nullif({earlier}, 0)"
    return f"CASE WHEN is_full THEN floor({ratio} * 1000)::BIGINT / 1000 END"


GROWTH_ALL = f"""{LOOKBACK},
earlier AS (
    SELECT *, {", ".join(f"lag(usd / nullif(coins, 0), {k}) OVER w AS p{k}" for k in (1, 2, 3, 7))}
    FROM looked WINDOW w AS (PARTITION BY symbol ORDER BY bar_no)
),
growths AS (
    {" UNION ALL ".join(
        f"SELECT symbol, part, date AS part_name, bar_no, time_open, "
        f"'price_increase_{k}' AS target_name, {_grown(f'p{k}')} AS value FROM earlier"
        for k in (1, 2, 3, 7)
    )}
)"""


FRAMES = {"price_increase_1": (1, 1), "price_increase_2_to_5": (2, 5), "price_increase_3_to_10": (3, 10)}


def _frame(start: int, end: int) -> str:
    if start == end:
        return f"lag(usd / nullif(coins, 0), {start}) OVER (PARTITION BY symbol ORDER BY bar_no)"
    rows = f"PARTITION BY symbol ORDER BY bar_no ROWS BETWEEN {end} PRECEDING AND {start} PRECEDING"
    usd, coins = (f"sum({c}::DECIMAL(28, 8)) OVER ({rows})::DOUBLE" for c in ("usd", "coins"))
    return f"{usd} / nullif({coins}, 0)"


FRAME_GROWTHS = f"""{LOOKBACK},
earlier AS (
    SELECT *, {", ".join(f"{_frame(a, b)} AS p{i}" for i, (a, b) in enumerate(FRAMES.values()))}
    FROM looked
),
growths AS (
    {" UNION ALL ".join(
        f"SELECT symbol, part, date AS part_name, bar_no, time_open, "
        f"'{name}' AS target_name, {_grown(f'p{i}')} AS value FROM earlier"
        for i, name in enumerate(FRAMES)
    )}
)"""


def _targets(bucket_key: str, growths: str = GROWTH_ALL) -> str:
    return f"""{growths},
targets AS (
    SELECT target_name, symbol, part, part_name, bar_no, time_open, value::FLOAT AS value
    FROM growths WHERE value >= 1.01::DOUBLE
    QUALIFY row_number() OVER (PARTITION BY symbol, target_name, {bucket_key} ORDER BY bar_no) = 1
)"""


TARGETS = _targets("bar_no // 10")
PART_TARGETS = _targets("part, bar_no // 13")
TARGET_COLUMNS = "target_name, symbol, part_name, time_open, value"


def _grid(before: int, after: int, source: str = "targets") -> str:
    return f"""grid AS (
    SELECT t.symbol, t.part, t.part_name, t.target_name, t.value AS target_value,
           t.time_open AS target_timestamp, t.bar_no AS target_no, o.off,
           t.time_open + to_days((o.off * 7)::INTEGER) AS timestamp,
           CASE WHEN o.off < 0 THEN -1 WHEN o.off = 0 THEN 0 WHEN o.off = 1 THEN 1 ELSE 2 END AS phase
    FROM {source} t, (SELECT unnest(generate_series({-before}, {after})) AS off) o
)"""


ENTRIES = """entries AS (
    SELECT symbol, bar_no - 1 AS target_no, part AS entry_part, avg * 1.001::DOUBLE AS price_in
    FROM bars
)"""

CASE_ROWS = f"""{TARGETS},
{_grid(8, 6)},
{ENTRIES},
case_rows AS (
    SELECT g.*, b.open, b.high, b.low, b.close, b.usd, b.coins, b.buy_coins, b.sell_usd, b.n, b.avg,
           e.price_in
    FROM grid g
    JOIN bars b ON b.symbol = g.symbol AND b.bar_no = g.target_no + g.off
        AND b.part BETWEEN g.part - 1 AND g.part
    JOIN entries e ON e.symbol = g.symbol AND e.target_no = g.target_no
        AND e.entry_part BETWEEN g.part - 1 AND g.part
    WHERE e.price_in <> 0 AND b.usd <> 0 AND b.coins <> 0
)"""

DENSE_ROWS = f"""{TARGETS},
{_grid(8, 6)},
{ENTRIES},
case_rows AS (
    SELECT g.*, coalesce(b.high, 0) AS high, coalesce(b.low, 0) AS low, coalesce(b.avg, 0) AS avg,
           coalesce(e.price_in, 0) AS price_in
    FROM grid g
    LEFT JOIN bars b ON b.symbol = g.symbol AND b.bar_no = g.target_no + g.off
        AND b.part BETWEEN g.part - 1 AND g.part
    LEFT JOIN entries e ON e.symbol = g.symbol AND e.target_no = g.target_no
        AND e.entry_part BETWEEN g.part - 1 AND g.part
)"""

CASE = "symbol, part_name, target_timestamp, target_name, target_value"


def _steps(order: str) -> str:
    return f"""steps AS (
    SELECT *, CASE WHEN coalesce(next, 0) <> 0 THEN floor((avg * 100 / next - 100) * 1000)
              ELSE 0 END::BIGINT AS step
    FROM (SELECT *, lead(avg) OVER (PARTITION BY {CASE} ORDER BY off {order}) AS next FROM case_rows)
)"""


def _step_sum(condition: str, name: str) -> str:
    total = f"coalesce(sum(step) FILTER (WHERE phase IN (0, -1) AND {condition}), 0)::DOUBLE"
    return f"round_even({total} / 10, 0) / 100 + 0 AS {name}"


STEP_SUMS = ",\n".join(
    [_step_sum("step > 0", S.RISES), _step_sum("step < 0", S.FALLS), _step_sum("true", S.MOVES)]
)


def _walk(order: str, exit_price: str) -> str:
    direction = {"asc": "max", "desc": "min"}[order]
    return f"""walk AS (
    SELECT *, CASE WHEN low = 0 OR avg = 0 THEN 0
                   WHEN low <= price_in * 0.05::DOUBLE THEN -50
                   WHEN (high + avg) / 2 >= price_in * 3 THEN 1
                   WHEN off = {direction}(off) OVER (PARTITION BY {CASE})
                        THEN {exit_price} * 0.999::DOUBLE * 100 / price_in - 100
                   ELSE 0 END::DOUBLE AS outcome
    FROM case_rows WHERE phase = 2
),
gains AS (
    SELECT {CASE}, round_even(coalesce(g, 0) * 1000, 0) / 1000 + 0 AS gain
    FROM (SELECT DISTINCT {CASE} FROM case_rows)
    LEFT JOIN (
        SELECT {CASE}, first(outcome ORDER BY off {order}) AS g FROM walk WHERE outcome <> 0
        GROUP BY {CASE}
    ) USING ({CASE})
)"""


BEST = """coalesce(floor(max(avg * 0.999::DOUBLE * 100 / price_in - 100) FILTER (WHERE phase = 2)), 0)"""
VOLUME = """floor(sum(usd::DECIMAL(28, 8)) FILTER (WHERE phase IN (0, -1))::DOUBLE
    / count(*) FILTER (WHERE phase IN (0, -1)))"""

REPORT = f"""SELECT sum(round_even(gain * 1000, 0)::BIGINT)::DOUBLE / 1000 AS ttl_gain_pct,
       sum(round_even(gain * 1000, 0)::BIGINT)::DOUBLE / 1000 / count(*) AS avg_gain_pct,
       count(*)::BIGINT AS ttl_ins,
       (count(*) FILTER (WHERE gain > 0))::DOUBLE / count(*) AS win_pct,
       target_name
FROM gains GROUP BY target_name"""

CASE_COLUMNS = f"""{CASE}, timestamp, off::INTEGER AS "offset", phase::INTEGER AS interval_id"""


def oracles() -> dict[str, str]:
    return {
        "bars_from_trades": f"WITH {BARS} SELECT {BAR_COLUMNS} FROM bars",
        "vwap": f"WITH {BARS} SELECT symbol, time_open, avg AS {S.AVG} FROM bars",
        "has_full_lookback": f"""WITH {LOOKBACK}
            SELECT symbol, time_open, is_full AS is_full_lookback FROM looked""",
        "growth": f"""WITH {LOOKBACK},
            earlier AS (
                SELECT *, sum(usd::DECIMAL(28, 8)) OVER w::DOUBLE
                    / nullif(sum(coins::DECIMAL(28, 8)) OVER w::DOUBLE, 0) AS before
                FROM looked
                WINDOW w AS (PARTITION BY symbol ORDER BY bar_no
                             ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING)
            )
            SELECT symbol, time_open, {_grown("before")} AS growth FROM earlier""",
        "growth_all": f"""WITH {GROWTH_ALL}
            SELECT symbol, part_name, time_open, target_name, value FROM growths""",
        "dedupe_max": f"""WITH {GROWTH_ALL}
            SELECT symbol, part_name, target_name, max(value) AS value FROM growths
            GROUP BY ALL""",
        "first_per_bucket": f"""WITH {BARS}
            SELECT {BAR_COLUMNS} FROM bars
            QUALIFY row_number() OVER (PARTITION BY symbol, bar_no // 10 ORDER BY bar_no) = 1""",
        "targets": f"WITH {TARGETS} SELECT {TARGET_COLUMNS} FROM targets",
        "targets_of_frames": f"""WITH {_targets("bar_no // 10", FRAME_GROWTHS)}
            SELECT {TARGET_COLUMNS} FROM targets""",
        "case_grid": f"""WITH {TARGETS}, {_grid(8, 6)} SELECT {CASE_COLUMNS} FROM grid""",
        "lookup_any": f"""WITH {TARGETS}, {_grid(8, 6)}
            SELECT g.symbol, g.part_name, g.target_timestamp, g.target_name, g.target_value,
                   g.timestamp, g.off::INTEGER AS "offset", g.phase::INTEGER AS interval_id,
                   coalesce(b.close, 0) AS {S.CLOSE}, coalesce(b.usd, 0) AS {S.USD},
                   coalesce(b.n, 0) AS {S.TRANSACTIONS}
            FROM grid g LEFT JOIN bars b
                ON b.symbol = g.symbol AND b.time_open = g.timestamp""",
        "entry_price": f"""WITH {BARS}
            SELECT symbol, time_open - INTERVAL 7 DAY AS target_timestamp,
                   avg * 1.001::DOUBLE AS price_in FROM bars""",
        "case_rows": f"""WITH {CASE_ROWS}
            SELECT {CASE_COLUMNS}, open AS {S.OPEN}, high AS {S.HIGH}, low AS {S.LOW},
                   close AS {S.CLOSE}, usd AS {S.USD}, coins AS {S.COINS},
                   buy_coins AS {S.TAKER_BUY_COINS}, sell_usd AS {S.TAKER_SELL_USD},
                   n AS {S.TRANSACTIONS}, avg AS {S.AVG}, price_in
            FROM case_rows""",
        "step_change_pct": f"""WITH {CASE_ROWS}, {_steps("asc")}
            SELECT {CASE}, timestamp, step / 1000 AS {S.STEP} FROM steps""",
        "step_change_pct_desc": f"""WITH {DENSE_ROWS}, {_steps("desc")}
            SELECT {CASE}, timestamp, step / 1000 AS {S.STEP} FROM steps""",
        "phase_sums": f"""WITH {CASE_ROWS}, {_steps("asc")}
            SELECT {CASE}, {STEP_SUMS} FROM steps GROUP BY {CASE}""",
        "first_outcome": f"""WITH {CASE_ROWS}, {_walk("asc", "avg")}
            SELECT {CASE}, gain AS {S.GAIN} FROM gains""",
        "first_outcome_desc": f"""WITH {DENSE_ROWS}, {_walk("desc", "low")}
            SELECT {CASE}, gain AS {S.GAIN} FROM gains""",
        "best_exit": f"""WITH {CASE_ROWS}
            SELECT {CASE}, {BEST} AS {S.BEST} FROM case_rows GROUP BY {CASE}""",
        "liquid_cases": f"""WITH {CASE_ROWS}
            SELECT {CASE}, {VOLUME} AS {S.AVG_VOLUME} FROM case_rows GROUP BY {CASE}
            HAVING {VOLUME} >= 50000""",
        "training_set": _training(CASE_ROWS),
        "feature_probe": f"""WITH {TARGETS},
            listed AS (
                SELECT * FROM targets t
                WHERE target_name = 'price_increase_1' AND (symbol, time_open) IN (
                    SELECT (symbol, max(time_open)) FROM targets GROUP BY symbol, part_name)
            ),
            {_grid(6, 3, "listed")},
            case_rows AS (
                SELECT g.*, coalesce(b.avg, 0) AS avg
                FROM grid g LEFT JOIN bars b
                    ON b.symbol = g.symbol AND b.bar_no = g.target_no + g.off
                    AND b.part BETWEEN g.part - 1 AND g.part
            ),
            {_steps("desc")}
            SELECT target_name, target_value, target_timestamp, symbol, {STEP_SUMS}
            FROM steps GROUP BY {CASE}""",
        "backtest_report": f"""WITH {DENSE_ROWS}, {_walk("desc", "low")} {REPORT}""",
        "replace_parts": f"WITH {PART_TARGETS} SELECT {TARGET_COLUMNS} FROM targets",
        "backfill": _training(CASE_ROWS.replace(TARGETS, PART_TARGETS)),
        "training_set_in_place": _training(CASE_ROWS.replace(TARGETS, PART_TARGETS)),
        "latest_version_in_place": f"WITH {TARGETS} SELECT {TARGET_COLUMNS} FROM targets",
        "new_bars": f"WITH {PART_TARGETS} SELECT {TARGET_COLUMNS} FROM targets",
        "latest_version": """SELECT * FROM events
            QUALIFY row_number() OVER (
                PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
        "yesterday": "SELECT * FROM events WHERE ts::DATE = DATE '2024-01-15'",
        "days_before": """SELECT * FROM events
            WHERE ts::DATE BETWEEN DATE '2024-01-14' AND DATE '2024-01-15'""",
        "tsv_round_trip": "SELECT conv_id, turn, role, text FROM conversations",
        "truncate": f"""WITH {TARGETS}
            SELECT 'before' AS moment, count(*)::BIGINT AS n FROM targets
            UNION ALL SELECT 'after', 0::BIGINT""",
    }


def _training(case_rows: str) -> str:
    return f"""WITH {case_rows}, {_steps("asc")}, {_walk("asc", "avg")},
        features AS (
            SELECT {CASE}, price_in, {BEST} AS best, {STEP_SUMS}, {VOLUME} AS volume
            FROM steps GROUP BY {CASE}, price_in
        )
        SELECT part_name, price_in AS {S.ENTRY}, gain AS {S.GAIN}, best AS {S.BEST}, target_name,
               target_value, target_timestamp, symbol AS target_symbol,
               {S.RISES}, {S.FALLS}, {S.MOVES}, volume AS {S.AVG_VOLUME}
        FROM features JOIN gains USING ({CASE}) WHERE volume >= 50000"""
