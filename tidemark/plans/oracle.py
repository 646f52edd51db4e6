"""Independent SQL (DuckDB dialect) for every batch query of the catalogue.

Written from the semantics, not from the DataFrame code: window functions
where the library uses aggregates, explicit CASE tables for the parser.
Tables are the driver's views (customer, orders, events, ...).
"""

from __future__ import annotations

_STAND_INS = """
t1 as (select c_custkey id, c_mktsegment gender from customer),
t2 as (select c_custkey id, c_name name from customer),
t3 as (select c_custkey id, c_acctbal score from customer)"""

_TOPN = """
select * from
  (select t1.id, name, gender, score,
          cast(row_number() over (partition by gender order by score desc nulls last, t1.id) as bigint) rn
   from t1 join t2 on t1.id = t2.id join t3 on t1.id = t3.id) t
where rn <= 2"""


def _h(text: str, digits: int = 6) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::int"


_K = "c_custkey::varchar"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = _UPPER + "abcdefghijklmnopqrstuvwxyz"
_GENDER = f"case when {_h(_K, 4)} % 2 = 0 then 'male' else 'female' end"
_SCORE = f"{_h(chr(39) + 's' + chr(39) + ' || ' + _K)} % 101"
_NAME = " || ".join(
    f"substr('{_UPPER if j == 0 else _LETTERS}', {_h(repr('n') + ' || ' + _K + ' || ' + repr(f':{j}'))}"
    f" % {26 if j == 0 else 52} + 1, 1)" for j in range(6))

# Line forms by last key digit, as text_lines builds them (see catalog.text_lines).
_TEXT_LINE = """case c_custkey % 10
      when 0 then 'x' || c_custkey::varchar || ', ' || c_mktsegment
      when 1 then c_custkey::varchar || ','
      when 2 then '+' || c_custkey::varchar || ',' || c_mktsegment
      when 3 then c_custkey::varchar || ',,' || c_mktsegment
      when 4 then ' ' || c_custkey::varchar || ',a'
      when 5 then c_custkey::varchar
      when 6 then c_custkey::varchar || ', ' || c_mktsegment || ',extra'
      else c_custkey::varchar || ', ' || c_mktsegment end"""


# Int line forms by last key digit, as int_lines builds them (see catalog.int_lines).
_INT_LINE = f"""case c_custkey % 10
      when 0 then c_custkey::varchar || ', ' || ({_SCORE})::varchar
      when 1 then c_custkey::varchar || ',3000000000'
      when 2 then c_custkey::varchar || ',' || ({_SCORE})::varchar || ','
      when 3 then c_custkey::varchar || ',-' || ({_SCORE})::varchar
      else c_custkey::varchar || ',' || ({_SCORE})::varchar end"""

_STRICT_INT = "regexp_full_match({x}, '[+-]?[0-9]+') and try_cast({x} as integer) is not null"


def _parsed(line_sql: str, second_is_int: bool) -> str:
    """Lines parsed in SQL: split on ',', trailing empty fields dropped, strict ints, reasons."""
    second = (f"when not ({_STRICT_INT.format(x='a[2]')}) then 'bad_int'" if second_is_int else "")
    return f"""
    select value, a,
           case when not ({_STRICT_INT.format(x='a[1]')}) then 'bad_int'
                when len(a) < 2 then 'missing_field'
                {second} end reason
    from (select value, string_split(regexp_replace(value, ',+$', ''), ',') a
          from (select {line_sql} as value from customer) l) p"""


def _state(cond: str = "true") -> str:
    return f"""
    select user_id id, event_type, value
    from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) k
          from events where {cond}) z
    where k = 1 and event_type <> 'error'"""


_CUT = "event_id * 2 < (select max(event_id) from events) + 1"

_DIFF_CTES = f"""
o as ({_state(_CUT)}),
n as ({_state()}),
diff as (
  select coalesce(n.id, o.id) id,
         case when o.id is null then 'c' when n.id is null then 'd' else 'u' end op,
         n.event_type, n.value
  from o full outer join n on o.id = n.id
  where o.id is null or n.id is null
     or o.event_type is distinct from n.event_type or o.value is distinct from n.value)"""


def _top(src: str) -> str:
    return f"""
    select * from (select id, event_type g, value score,
                          cast(row_number() over (partition by event_type
                                                  order by value desc nulls last, id) as bigint) rn
                   from {src}) z where rn <= 2"""


ORACLE_SQL: dict[str, str] = {
    "topn_join3": f"with {_STAND_INS} {_TOPN}",
    "topn_join3_sql": f"with {_STAND_INS} {_TOPN}",
    "join3_inner": f"""with {_STAND_INS}
        select t1.id, name, gender, score from t1 join t2 on t1.id = t2.id join t3 on t1.id = t3.id""",
    "row_number_by_group": f"""with {_STAND_INS}
        select t1.id, gender, score,
               cast(row_number() over (partition by gender order by score desc nulls last, t1.id) as bigint) rn
        from t1 join t3 on t1.id = t3.id""",
    "topn_per_group": """
        select * from (select o_orderkey, o_orderpriority, o_totalprice,
                              cast(row_number() over (partition by o_orderpriority
                                   order by o_totalprice desc nulls last, o_orderkey) as bigint) rn
                       from orders) z where rn <= 2""",
    "insert_aligned": f"""with {_STAND_INS}
        select cast(id as integer) id, name, gender, cast(trunc(score) as integer) score, rn
        from ({_TOPN}) r""",
    "insert_declared": f"""with {_STAND_INS}
        select cast(id as integer) id, name, gender, cast(trunc(score) as integer) score, rn
        from ({_TOPN}) r""",
    "topn_large": """
        select * from (select o_orderkey, o_orderpriority, o_totalprice,
                              cast(row_number() over (partition by o_orderpriority
                                   order by o_totalprice desc nulls last, o_orderkey) as bigint) rn
                       from orders) z where rn <= 1500""",
    "replicate_table": "select c_custkey id, c_mktsegment gender from customer",
    "gen_gender": f"select c_custkey id, {_GENDER} gender from customer",
    "gen_name": f"select c_custkey id, {_NAME} name from customer",
    "gen_score": f"select c_custkey id, {_SCORE} score from customer",
    "gen_bounded": f"""
        select c_custkey seq, 1 + {_h("'b' || " + _K)} % 1000 id,
               substr(md5('n0:' || {_K}), 1, 9) name, substr(md5('g0:' || {_K}), 1, 6) gender
        from customer""",
    "format_lines": f"""
        select {_K} || ', ' || {_GENDER} value, 'test1' topic from customer
        union all select {_K} || ', ' || {_NAME}, 'test2' from customer
        union all select {_K} || ',' || ({_SCORE})::varchar, 'test3' from customer""",
    "parse_id_text": f"""
        select cast(a[1] as integer) id, a[2] gender from ({_parsed(_TEXT_LINE, False)}) q
        where reason is null""",
    "parse_id_int": f"""
        select cast(a[1] as integer) id, cast(a[2] as integer) score from ({_parsed(_INT_LINE, True)}) q
        where reason is null""",
    "parse_rejects": f"""
        select value, reason from ({_parsed(_TEXT_LINE, False)}) q where reason is not null""",
    "cdc_parse_envelope": """
        select case when event_type = 'error' then 'd' else 'u' end op, user_id id, event_type, value,
               epoch_us(ts) // 1000 ts_ms, 'events' file, event_id pos
        from events""",
    "cdc_current_state": _state(),
    "changelog_diff": f"with {_DIFF_CTES} select * from diff",
    "apply_changes": f"""with {_DIFF_CTES}
        select id, event_type, value from o where not exists (select 1 from diff where diff.id = o.id)
        union all select id, event_type, value from diff where op <> 'd'""",
    "upsert_by_key": """
        with src as (select user_id id, event_type name
                     from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) k
                           from events) z where k = 1)
        select c_custkey id, c_name name from customer where c_custkey not in (select id from src)
        union all select id, name from src""",
    "topn_delta": f"""with {_DIFF_CTES},
        top_o as ({_top('o')}), top_n as ({_top('n')})
        select coalesce(b.id, a.id) id,
               case when a.id is null then 'c' when b.id is null then 'd' else 'u' end op,
               b.g, b.score, b.rn
        from top_o a full outer join top_n b on a.id = b.id
        where a.id is null or b.id is null or a.g is distinct from b.g
           or a.score is distinct from b.score or a.rn is distinct from b.rn""",
}
