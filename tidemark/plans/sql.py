"""The views of tidemark.sources.views in SQL, to put before an oracle's SELECT."""

from __future__ import annotations

VIEWS = {
    "ticks": """ticks as (select user_id + 1 as k, (epoch_us(ts) // 1000) as t, round(value * 100)::bigint as price, event_id, event_type as kind from events)""",
    "bars": """bars as (select k, t // 60000 * 60000 as t, first(price order by t, event_id) as open, max(price) as high, min(price) as low,
  last(price order by t, event_id) as close, count(*) as volume, sum(price)::bigint as turnover from ticks group by k, ticks.t // 60000 * 60000)""",
    "hours": """hours as (select k, t // 3600000 * 3600000 as t, first(price order by t, event_id) as open, max(price) as high, min(price) as low,
  last(price order by t, event_id) as close, count(*) as volume, sum(price)::bigint as turnover from ticks group by k, ticks.t // 3600000 * 3600000)""",
    "settlement_rows": """settlement_rows as (select o_custkey + 1 as k, (epoch_us(o_orderdate) // 1000) as t, round(o_totalprice * 100)::bigint as rate, o_orderkey as id from orders)""",
    "settlements": """settlements as (select k, t, arg_min(rate, id) as rate, min(id) as id from settlement_rows group by k, t)""",
    "snapshots": """snapshots as (select o_custkey + 1 as k, (epoch_us(o_orderdate) // 1000) as t, arg_min(o_orderstatus, o_orderkey) as status,
  arg_min(o_orderpriority, o_orderkey) as symbol, min(o_orderkey) as id from orders group by 1, 2)""",
    "probes": """probes as (select o_custkey + 1 as k, (epoch_us(l_shipdate) // 1000) as t, l_orderkey, l_linenumber::bigint as line, l_partkey from lineitem join orders on l_orderkey = o_orderkey)""",
    "instruments": """instruments as (select p_partkey + 1 as k, 'P' || p_partkey || 'USDT' as symbol, p_name as name, p_type as kind, p_brand as brand,
  round(p_retailprice * 100)::bigint as price, p_size::bigint as size from part)""",
    "tickers": """tickers as (select 'P' || l_partkey || 'USDT' as symbol, min(round(l_extendedprice * 100)::bigint // l_quantity::bigint) as low,
  max(round(l_extendedprice * 100)::bigint // l_quantity::bigint) as high, sum(round(l_extendedprice * 100)::bigint)::bigint as turnover, count(*) as n
  from lineitem group by l_partkey)""",
}
NEEDS = {"bars": ["ticks"], "hours": ["ticks"], "settlements": ["settlement_rows"]}


def with_views(*names: str, sql: str) -> str:
    """SQL with the named views (and those that they need) as common table expressions."""
    order: list[str] = []
    for name in names:
        for need in [*NEEDS.get(name, []), name]:
            if need not in order:
                order.append(need)
    body = sql.strip()
    lead = "with " + ",\n".join(VIEWS[n] for n in order)
    return f"{lead},\n{body[5:]}" if body.lower().startswith("with ") else f"{lead}\n{body}"
