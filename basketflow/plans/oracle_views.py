"""The logical views in DuckDB's dialect, for the independent SQL oracle.

``with_views(body, *names)`` prefixes a query with the CTEs it needs (and
their dependencies), so each oracle string runs on the raw driver tables.
"""

from __future__ import annotations

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_ratings": ((), """
select o_custkey as user_id, l_partkey as item_id,
       max(cast(floor((l_quantity - 1) / 10) as integer) + 1) as rating
from orders join lineitem on o_orderkey = l_orderkey
group by o_custkey, l_partkey"""),
    "v_orders": ((), """
select o_orderkey as order_id, o_custkey as user_id,
       case when n < cnt then 'prior' when o_custkey % 3 = 0 then 'test' else 'train' end as eval_set,
       cast(n as integer) as order_number,
       cast(((datediff('day', date '1995-01-01', cast(o_orderdate as date)) % 7) + 7) % 7 as integer) as order_dow,
       cast(o_orderkey % 24 as integer) as order_hour_of_day,
       case when p is null then ''
            else concat(cast(datediff('day', cast(p as date), cast(o_orderdate as date)) as varchar), '.0')
       end as days_since_prior_order
from (select o_orderkey, o_custkey, o_orderdate,
             row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n,
             count(*) over (partition by o_custkey) as cnt,
             lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as p
      from orders) s"""),
    "v_order_products": (("v_orders",), """
select l_orderkey as order_id, l_partkey as product_id, l_linenumber as add_to_cart_order, eval_set,
       case when order_number > min(order_number) over (partition by user_id, l_partkey)
            then '1' else '0' end as reordered
from lineitem join v_orders on order_id = l_orderkey"""),
    "v_prior": (("v_order_products",), """
select order_id, product_id, add_to_cart_order, reordered from v_order_products where eval_set = 'prior'"""),
    "v_train": (("v_order_products",), """
select order_id, product_id, add_to_cart_order, reordered from v_order_products where eval_set = 'train'"""),
    "v_sentences": ((), """
select doc_id,
       concat(array_to_string(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> ''), ' '),
              '##@@##', lang) as sentence,
       lang as label
from documents"""),
    "v_event_json": ((), """
select event_id, cast(user_id % 4 as integer) as part,
       cast(json_object('order_id', event_id, 'user_id', user_id, 'eval_set', event_type) as varchar) as msg
from events"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in _VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``with v1 as (...), v2 as (...), <extra ctes> <body>``."""
    ctes = [f"{n} as ({_VIEWS[n][1]}\n)" for n in _order(names)]
    for n, sql in extra or []:
        ctes.append(f"{n} as ({sql}\n)")
    if not ctes:
        return body
    return "with " + ",\n".join(ctes) + "\n" + body


def exact_sum_sql(x: str) -> str:
    """DuckDB aggregate: the sum of a double, independent of the order (30-bit limbs)."""
    out = []
    for k in reversed(range(5)):
        scale = f"pow(2.0, {30 * k})"
        out.append(f"cast(sum(cast(floor((abs({x}) * {scale}) % 1073741824.0) as bigint) * cast(sign({x}) as bigint))"
                   f" as double) / {scale}")
    out.append(f"cast(sum(cast(floor(abs({x}) / 1073741824.0) as bigint) * cast(sign({x}) as bigint)) as double)"
               " * 1073741824.0")
    return "(" + " + ".join(out) + ")"
