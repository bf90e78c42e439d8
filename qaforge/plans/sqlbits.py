"""Pieces of the SQL that the queries are compared with."""

#: Unicode white space as a character class of the SQL engine's regular expressions.
WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{WS}+|{WS}+$', '', 'g')"


def squash(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def answer_text(x: str) -> str:
    return squash(f"replace(replace(lower({strip(x)}), '$', ''), ',', '')")


def label_text(x: str) -> str:
    return squash(f"lower({strip(x)})")


def canonical(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"case when {s} in ('train', 'training') then 'train' when {s} in ('val', 'dev', 'valid', 'validation', 'eval') then 'val' when {s} in ('test', 'test_gold') then 'test' else '' end"


#: Gold and predicted figures derived from lineitem: 0 exact, 1 currency, 2 rounded, 3 sign flip, 4 percent, 5 abstains, 6 empty, 7 wrong.
NUMERIC_PAIRS = """
  select l_orderkey, l_linenumber, kind, gold,
    case kind when 0 then gold when 1 then concat('$', gold) when 2 then cast(cast(round(cents / 100.0e0) as bigint) as varchar(20))
      when 3 then concat('-', gold) when 4 then concat(gold, '%') when 5 then 'cannot be determined' when 6 then ''
      else cast(cents * 3 as varchar(20)) end as prediction
  from (select l_orderkey, l_linenumber, (l_orderkey + l_linenumber) % 8 as kind, cents,
      concat(cast((cents - cents % 100) / 100 as bigint), '.', lpad(cast(cents % 100 as varchar(20)), 2, '0')) as gold
    from (select l_orderkey, l_linenumber, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem) a) b
"""

#: Programs over lineitem in eight shapes with what they give: flat chains, nested calls, constants, percentages, tables, a
#: comparison, and programs that fail (unknown operator, division by zero, an open call).
PROGRAMS = """
  select l_orderkey, l_linenumber, kind, program, expected, expected_txt, kind <> 7 as runs,
    case when kind = 3 then expected_txt when kind = 7 then 'n/a' when kind in (0, 2, 4) then cast(cast(expected as bigint) as varchar(20)) else concat(cast(cast((m - m % 1000000) / 1000000 as bigint) as varchar(20)), '.', lpad(cast(m % 1000000 as varchar(20)), 6, '0')) end as gold
  from (select *, cast(floor(expected * 1000000) as bigint) as m from (select l_orderkey, l_linenumber, kind, case kind
      when 0 then concat('multiply(', q, ', ', s, '), subtract(#0, ', n, ')') when 1 then concat('add(', q, ', ', s, '), divide(#0, const_100)')
      when 2 then concat('subtract(add(', q, ', ', s, '), ', n, ')') when 3 then concat('greater(', q, ', ', s, ')') when 4 then concat('exp(', n, ', const_2)')
      when 5 then concat('table_average(', q, ', ', s, ', ', n, ')') when 6 then concat('divide($', s, ', ', q, '), multiply(#0, 15%)')
      else case l_linenumber % 3 when 0 then concat('multiply(', q, ', power(', s, '))') when 1 then concat('divide(', q, ', const_0)') else concat('add(', q, ', subtract(', s, ', ', n, ')') end end as program,
    case kind when 0 then q0 * s0 - n0 when 1 then (q0 + s0) / 100.0e0 when 2 then q0 + s0 - n0 when 4 then n0 * n0 when 5 then (q0 + s0 + n0) / 3.0e0 when 6 then s0 / q0 * 0.15e0 end as expected,
    case when kind = 3 then case when q0 > s0 then 'yes' else 'no' end end as expected_txt
  from (select l_orderkey, l_linenumber, (l_orderkey + l_linenumber) % 8 as kind, cast(cast(l_quantity as bigint) as varchar(20)) as q, cast(l_suppkey as varchar(20)) as s, cast(l_linenumber as varchar(20)) as n,
      cast(cast(l_quantity as bigint) as double) as q0, cast(l_suppkey as double) as s0, cast(l_linenumber as double) as n0 from lineitem) a) b) c
"""

#: Raw records over orders whose gold answer is the reference, an executed answer, or that of a turn by the id or by number.
GOLD = """
  select o_orderkey, o_orderkey % 5 as kind, case o_orderkey % 5 when 2 then concat('d', cast(o_orderkey as varchar(20)), '_1') when 3 then concat('d', cast(o_orderkey as varchar(20))) else concat('f', cast(o_orderkey as varchar(20))) end as id,
    case when o_orderkey % 5 in (2, 3) then 'ConvFinQA' when o_orderkey % 5 = 4 then 'tatqa' else 'finqa' end as source, case o_orderkey % 5 when 0 then o_orderpriority when 4 then ' ' else '' end as reference_answer,
    case o_orderkey % 5
      when 0 then concat('{"raw_sample": {"qa": {"answer": "other", "program": "add(1, 2)", "program_re": "add(', cast(o_custkey as varchar(20)), ', 2)"}}}')
      when 1 then concat('{"raw_sample": {"qa": {"answer": 0, "exe_ans": ', cast(o_custkey as varchar(20)), ', "program": "add(3, 4)", "program_re": ""}}}')
      when 2 then concat('{"raw_sample": {"qa_0": {"answer": "first"}, "qa_1": {"answer": "turn ', cast(o_custkey as varchar(20)), '", "program_re": "exp(2, 3)"}, "qa_2": {"answer": "last"}}}')
      when 3 then concat('{"raw_sample": {"qa_9": {"answer": "nine"}, "qa_10": {"answer": "", "exe_ans": "ten ', cast(o_custkey as varchar(20)), '"}}}')
      else '{"raw_sample": {"qa": {"answer": "none of it"}}}' end as metadata
  from orders
"""

#: Multiple-choice answers over part in twelve forms, with the option (from 0) that each selects.
MCQ = """
  select p_partkey, substr('ABCD', cast(p_size % 4 + 1 as int), 1) as reference_answer,
    case p_partkey % 12 when 0 then l when 1 then concat('Option ', l) when 2 then concat('(', lower(l), ') text') when 3 then '' when 4 then 'cannot determine' when 5 then concat('Option', l) when 6 then concat('answer', lower(l))
      when 7 then concat('The answer is ', l, '.') when 8 then cast(k + 1 as varchar(20)) when 9 then w when 10 then concat('I would take the ', upper(w), ' one') else concat('Choice: ', l) end as model_answer,
    case when p_partkey % 12 in (3, 4) then null else k end as selects
  from (select p_partkey, p_size, p_partkey % 4 as k, substr('ABCD', cast(p_partkey % 4 + 1 as int), 1) as l, case p_partkey % 4 when 0 then 'economy' when 1 then 'standard' when 2 then 'large' else 'promo' end as w from part) a
"""

#: Model replies over all samples in five forms: tags, JSON, marker, last line, fenced JSON.
REPLIES = """
  select row_id, task_type, question, case row_id % 5
    when 0 then concat('<reasoning>', chr(10), 'step ', cast(row_id as varchar(20)), chr(10), '</reasoning>', chr(10), '<final_answer>', cast(row_id * 2 as varchar(20)), '</final_answer>')
    when 1 then concat('{"reasoning": "step ', cast(row_id as varchar(20)), '", "final_answer": "', cast(row_id * 2 as varchar(20)), '"}')
    when 2 then concat('step ', cast(row_id as varchar(20)), chr(10), 'Final answer: ', cast(row_id * 2 as varchar(20)))
    when 3 then concat('step ', cast(row_id as varchar(20)), chr(10), cast(row_id * 2 as varchar(20)))
    else concat('```json', chr(10), '{"reasoning": "step ', cast(row_id as varchar(20)), '", "final_answer": "', cast(row_id * 2 as varchar(20)), '"}', chr(10), '```') end as reply
  from qa_samples
"""


def close(a: str, b: str, rel: str, tol: str) -> str:
    return f"(abs(({a}) - ({b})) <= greatest({rel} * greatest(abs({a}), abs({b})), {tol}))"


#: Number of a prediction of NUMERIC_PAIRS, read strictly: NULL if it is no number; percentages keep their figure.
PRED_NUM = "try_cast(replace(replace(prediction, '$', ''), '%', '') as double)"
GOLD_NUM = "cast(gold as double)"
