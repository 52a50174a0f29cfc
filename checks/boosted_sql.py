"""Boosted trees in plain SQL: every round and level a few CTEs, for small models over columns of few values.

Sums per (node, feature, value), the best split of each node, the leaves and the margins are
recomputed from the rows; nothing is taken from the trained model.
"""

from __future__ import annotations

#: Rows of a boosted model: id, y, is_val, x (a list of features), and the keys that a query returns.
LINEITEM = """select row_number() over () as id, l_orderkey, l_linenumber,
    cast('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber)), 1, 8) as bigint) % 1000 < 200 as is_val,
    [l_quantity, l_discount, l_tax, year(l_shipdate), l_linenumber]::double[] as x, {label} as y
from lineitem"""
FEATURES = ["l_quantity", "l_discount", "l_tax", "ship_year", "l_linenumber"]


def _unit(limit: str) -> str:
    return f"pow(2.0, ceil(log2(greatest({limit}, 1e-12))) - 20)"


def boosted(
    label: str, last: str, kind: str = "logistic", rounds: int = 3, depth: int = 2, rate: float = 0.3, least: int = 20, reg: float = 1.0,
    classes: int = 1,
) -> str:
    """WITH everything up to `nodes` (round, class, place, ...) and `margins` (round, class, id, y, is_val, m), then `last`."""
    parts = {"source": LINEITEM.format(label=label), "train": "select * from source where not is_val"}
    ks = f"(select unnest(range({classes})) as k)"
    if kind == "logistic":
        parts["weight"] = "select count(*) filter (where y = 0) / greatest(count(*) filter (where y = 1), 1)::double as w from train"
        parts["base"] = """select (sum(y) + (any_value(w) - 1) * sum(y)) / (count(*) + (any_value(w) - 1) * sum(y)) as p,
            any_value(w) as w from train, weight"""
        parts["consts"] = f"""select ln(p / (1 - p)) as start, w, {_unit('greatest(p, 1 - p) * greatest(w, 1)')} as ug,
            {_unit('p * (1 - p) * greatest(w, 1)')} as uh from base"""
        gradient = "1 / (1 + exp(-m)) as p", "(p - y) * case when y = 1 then w else 1 end", "greatest(p * (1 - p), 1e-6) * case when y = 1 then w else 1 end"
    elif kind == "softmax":
        parts["consts"] = "select 0.0::double as start, pow(2.0, -20) as ug, pow(2.0, -21) as uh"
        gradient = (
            "exp(m - max(m) over (partition by id)) / sum(exp(m - top)) over (partition by id) as p",
            "p - (y = k)::int", "greatest(2 * p * (1 - p), 1e-6)")
    else:  # poisson
        parts["consts"] = f"""select ln(a) as start, {_unit('greatest(a - least_y, most_y - a)')} as ug, {_unit('a')} as uh
            from (select avg(y) as a, min(y) as least_y, max(y) as most_y from train)"""
        gradient = "exp(m) as p", "p - y", "greatest(p, 1e-6)"
    parts["m0"] = f"select id, k, y, is_val, x, start as m from source, consts, {ks}"
    nodes, margins = [], []
    for r in range(rounds):
        top = "max(m) over (partition by id) as top, " if kind == "softmax" else ""
        inner = f"(select *, {top}1 as place from m{r})"
        parts[f"p{r}"] = f"select *, {gradient[0]} from {inner}"
        parts[f"n{r}_0"] = f"""select id, k, y, is_val, x, m, place, round_even(({gradient[1]}) / ug, 0) * ug as g,
            round_even(({gradient[2]}) / uh, 0) * uh as h from p{r}, consts"""
        for d in range(depth):
            rows = f"n{r}_{d}"
            parts[f"cells{r}_{d}"] = f"""select k, place, f, v, sum(g) as g, sum(h) as h, count(*) as n
                from (select k, place, g, h, unnest(range(1, len(x) + 1)) as f, unnest(x) as v from {rows}
                    where not is_val and place >= {1 << d}) group by all"""
            parts[f"total{r}_{d}"] = f"select k, place, sum(g) as tg, sum(h) as th, count(*) as tn from {rows} where not is_val group by all"
            parts[f"best{r}_{d}"] = f"""select distinct on (k, place) * from (
                select *, (g * g / (h + {reg}) + (tg - g) * (tg - g) / (th - h + {reg}) - tg * tg / (th + {reg})) / 2 as gain
                from (select k, place, f, v, sum(g) over upto as g, sum(h) over upto as h, sum(n) over upto as n
                    from cells{r}_{d} window upto as (partition by k, place, f order by v))
                join total{r}_{d} using (k, place) where n >= {least} and tn - n >= {least})
                where gain > 1e-12 order by k, place, gain desc, f, v"""
            parts[f"n{r}_{d + 1}"] = f"""select id, a.k, y, is_val, x, m, a.g, a.h,
                case when b.place is null then a.place else 2 * a.place + (x[b.f] > b.v)::int end as place
                from {rows} as a left join best{r}_{d} as b on a.k = b.k and a.place = b.place"""
            nodes.append(f"""select {r} as round, k as class, place, f, v as threshold, gain, th as cover, tn as rows,
                null::double as value from best{r}_{d}""")
        parts[f"leaf{r}"] = f"""select k, place, -{rate} * sum(g) / (sum(h) + {reg}) as value, sum(h) as cover, count(*) as rows
            from n{r}_{depth} where not is_val group by all"""
        nodes.append(f"select {r}, k, place, null, null, null, cover, rows, value from leaf{r}")
        parts[f"m{r + 1}"] = f"select id, k, y, is_val, x, m + value as m from n{r}_{depth} join leaf{r} using (k, place)"
        margins.append(f"select {r} as round, k, id, y, is_val, m from m{r + 1}")
    names = ", ".join(f"'{f}'" for f in FEATURES)
    parts["nodes"] = f"select *, [{names}][f] as feature from ({' union all '.join(nodes)})"
    parts["margins"] = " union all ".join(margins)
    return "with " + ",\n".join(f"{n} as materialized ({q})" for n, q in parts.items()) + "\n" + last


NODES = """select round::int as round, class::int as class, place::bigint as place, feature, round(threshold, 6) as threshold, round(gain, 4) as gain,
    round(cover, 4) as cover, rows, round(value, 6) as value from nodes"""

IMPORTANCE = "\nunion all\n".join(
    f"select '{kind}' as kind, f as feature, round(coalesce(x, 0)::double, 4) as importance from "
    f"(select unnest([{', '.join(repr(f) for f in FEATURES)}]) as f) left join "
    f"(select feature, {fn} as x from nodes where feature is not null group by feature) on f = feature"
    for kind, fn in (("weight", "count(*)"), ("gain", "avg(gain)"), ("total_gain", "sum(gain)"), ("cover", "avg(cover)"), ("total_cover", "sum(cover)")))

CURVES = """, s as (select *, case when is_val then 'val' else 'train' end as part, 1 / (1 + exp(-m)) as p from margins),
ranked as (select *, rank() over (partition by part, round order by p)
    + (count(*) over (partition by part, round, p) - 1) / 2 as standing from s),
curves as (select part, round, avg(-case when y = 1 then ln(p) else ln(1 - p) end) as logloss,
    (sum(standing) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2)
        / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as auc_roc from ranked group by all)
select part, round::int as round, 'logloss' as metric, round(logloss, 6) as value from curves
union all select part, round::int, 'auc_roc', round(auc_roc, 6) from curves"""

CLASS_CURVES = """, e as (select *, exp(m - max(m) over (partition by round, id)) as e from margins),
s as (select *, e / sum(e) over (partition by round, id) as p from e),
rows as (select round, id, any_value(is_val) as is_val, max(p) filter (where k = y) as own,
    arg_max(k, (p, -k)) = any_value(y) as hit from s group by round, id),
curves as (select case when is_val then 'val' else 'train' end as part, round, avg(-ln(own)) as mlogloss, avg(hit::int) as accuracy
    from rows group by all)
select part, round::int as round, 'mlogloss' as metric, round(mlogloss, 6) as value from curves
union all select part, round::int, 'accuracy', round(accuracy, 6) from curves"""

SCORES = f"""select l_orderkey, l_linenumber, round(1 / (1 + exp(-m)), 6) as score, (m >= 0)::int as predicted
from margins join (select id, l_orderkey, l_linenumber from source) using (id) where is_val and round = 2"""
