"""Chinese numerals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: numeral letters and their numbers
DIGITS = "零一二三四五六七八九"


def _sql_digit(n: str) -> str:
    return f"substring('{DIGITS}', cast({n} AS int) + 1, 1)"


def _section(n: str) -> str:
    th, h, t, o = f"({n} div 1000 % 10)", f"({n} div 100 % 10)", f"({n} div 10 % 10)", f"({n} % 10)"
    return (
        f"concat(if({th} > 0, concat({_sql_digit(th)}, '千'), ''),"
        f" if({h} > 0, concat({_sql_digit(h)}, '百'), if({th} > 0 AND {t} + {o} > 0, '零', '')),"
        f" if({t} > 0, concat({_sql_digit(t)}, '十'), if({h} > 0 AND {o} > 0, '零', '')),"
        f" if({o} > 0, {_sql_digit(o)}, ''))"
    )


def to_chinese(n: str) -> Column:
    """1..99,999,999 in Chinese; null beyond. Inner zeros are written once. 10 to 19 are 十 to 十九, at the start of the whole
    numeral and after 万零 alike."""
    hi, lo = f"({n} div 10000)", f"({n} % 10000)"
    text = f"concat(if({hi} > 0, concat({_section(hi)}, '万', if({lo} > 0 AND {lo} < 1000, '零', '')), ''), {_section(lo)})"
    return F.expr(f"CASE WHEN {n} BETWEEN 1 AND 99999999 THEN regexp_replace({text}, '^一十|(?<=万零)一十', '十') END")


#: The letters of a numeral, as in statute.LABEL_LETTERS.
NUMERAL = "[一二三四五六七八九十百千万零两〇0-9]+"


def from_chinese(text: str) -> Column:
    """The number of a numeral, ASCII and full-width digits included, white space around it aside; null where a letter is no numeral."""
    digit = "CASE WHEN c IN ('〇', '零') THEN 0 WHEN c = '两' THEN 2 ELSE cast(instr('一二三四五六七八九', c) AS bigint) END"
    fold = f"""aggregate(filter(split(t, ''), c -> c <> ''), named_struct('total', 0L, 'section', 0L, 'num', 0L), (a, c) -> CASE
      WHEN c IN ('十', '百', '千') THEN named_struct('total', a.total, 'section', a.section + if(a.num = 0, 1L, a.num) * CASE c WHEN '十' THEN 10L WHEN '百' THEN 100L ELSE 1000L END, 'num', 0L)
      WHEN c = '万' THEN named_struct('total', a.total + (a.section + a.num) * 10000L, 'section', 0L, 'num', 0L)
      ELSE named_struct('total', a.total, 'section', a.section, 'num', {digit}) END, a -> a.total + a.section + a.num)"""
    plain = f"translate(regexp_replace({text}, '(?U)^\\\\s+|\\\\s+$', ''), '０１２３４５６７８９', '0123456789')"
    return F.expr(f"transform(array({plain}), t -> CASE WHEN t RLIKE '^[0-9]+$' THEN try_cast(t AS bigint) WHEN t RLIKE '^[〇零一二两三四五六七八九十百千万]+$' THEN {fold} END)[0]")


def article_parts(label: str) -> tuple[Column, Column]:
    """Number and suffix of a whole article label such as 第二百二十五条之一; null where it is none."""
    pattern = f"^第({NUMERAL})条(?:之({NUMERAL}))?$"
    return tuple(from_chinese(f"nullif(regexp_extract({label}, '{pattern}', {k}), '')") for k in (1, 2))


def article_key(label: str) -> Column:
    """NNNN or NNNN-SS of a whole article label such as 第二百二十五条之一; null for anything else."""
    no, suffix = article_parts(label)
    padded = lambda n, width: F.lpad(n.cast("string"), F.greatest(F.lit(width), F.length(n.cast("string"))), "0")
    return F.when(no.isNotNull(), F.concat(padded(no, 4), F.when(suffix.isNotNull(), F.concat(F.lit("-"), padded(suffix, 2))).otherwise("")))


def short_numeral(n) -> Column:
    """0..99,999 in the short style of the query functions: one digit a unit, 十 without 一 everywhere; null beyond."""
    return _short(n)


def lookup_article(c: str) -> Column:
    """The article label a question means: the first label in it without blanks, else all of it; 12, 第12条 and 12条之1 are
    written in Chinese, a label without 第 gets one. Empty stays empty, null gives empty."""
    letters = "[一二三四五六七八九十百千万零〇两0-9０-９]"
    given = f"regexp_replace(coalesce({c}, ''), '(?U)^\\\\s+|\\\\s+$', '')"
    token = f"replace(regexp_extract(t, '(第?\\\\s*{letters}{{1,12}}\\\\s*条(?:之\\\\s*{letters}{{1,3}})?)', 1), ' ', '')"
    arabic = "'^(?U)\\\\s*第?\\\\s*([0-9]{1,5})\\\\s*条?(?:(?<=条)之\\\\s*([0-9]{1,2}))?\\\\s*$'"
    number = lambda k: f"try_cast(regexp_extract(translate(t, '０１２３４５６７８９', '0123456789'), {arabic}, {k}) AS int)"
    bound = F.expr(f"transform(transform(array({given}), t -> if({token} <> '', {token}, t)), t -> struct(t AS t, {number(1)} AS n, {number(2)} AS s))[0]")
    return _bind(bound, lambda x: F.when(x["n"].isNotNull(), F.concat(F.lit("第"), _short(x["n"]), F.lit("条"), F.coalesce(F.concat(F.lit("之"), _short(x["s"])), F.lit(""))))
                 .when(F.contains(x["t"], F.lit("条")) & ~F.startswith(x["t"], F.lit("第")), F.concat(F.lit("第"), x["t"])).otherwise(x["t"]))


def _bind(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _short(n: Column) -> Column:
    digit = lambda k: (n / F.lit(10**k)).cast("int") % F.lit(10)
    parts = [F.when(digit(k) > 0, F.concat(F.substring(F.lit(DIGITS), digit(k) + F.lit(1), F.lit(1)), F.lit(unit))).otherwise(F.lit("零")) for k, unit in ((4, "万"), (3, "千"), (2, "百"), (1, "十"), (0, ""))]
    text = F.replace(F.regexp_replace(F.regexp_replace(F.concat(*parts), "零+", "零"), "^零|零$", ""), F.lit("一十"), F.lit("十"))
    return F.when(n == 0, F.lit("零")).when(n.between(1, 99999), text)
