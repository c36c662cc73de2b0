"""Status, role, event and answer labels, keyword filters, markers and file names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words of each label, asked in this order
STATUS_GIVEN = {"effective": ["1", "有效", "现行有效", "effective"], "amended": ["已修改", "修正", "修订", "amended"], "repealed": ["废止", "失效", "0", "repealed", "invalid"]}
STATUS_WORDS = {"repealed": ["予以废止", "同时废止", "已经废止", "宣布废止", "废止。", "废止；", "废止,", "废止，"], "amended": ["修正", "修订"]}
ROLE_WORDS = {"reply": ["批复", "答复", "复函", "函复"], "request": ["请示", "报告"], "shell": ["通知", "公告", "印发", "转发", "通报"]}
EVENT_WORDS = {"revision": ["修订"], "amendment": ["修正"], "adoption": ["通过", "公布", "施行"]}
YES = ["true", "1", "yes", "y", "interprets"]
BASIS_WORDS = ["依照", "根据", "按照", "参照", "所列", "除外", "规定的情形", "规定办理"]
MEANING_WORDS = ["是指", "所称", "系指", "含义", "解释如下", "批复如下", "答复如下"]
STOP_KEYWORDS = ["本院认为", "经审理查明", "依法", "依照", "依据", "根据", "相关规定", "有关规定", "判决如下", "现已审理终结", "事实清楚", "证据确实充分", "构成犯罪", "应予惩处"]


def stripped(c) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def has_any(c, words: list[str]) -> Column:
    """Whether any of the words, which hold no regular expression signs, is in the text: one scan by an alternation."""
    return F.coalesce(c, F.lit("")).rlike("|".join(words).replace(".", r"\."))


def _first(c, table: dict[str, list[str]], rest: str) -> Column:
    cases = [F.when(has_any(c, words), F.lit(label)) for label, words in table.items()]
    return F.coalesce(*cases, F.lit(rest))


def status(given, preface) -> Column:
    """effective, amended or repealed: by the given status, else by words of the preface; nulls count as empty."""
    text = F.lower(stripped(F.coalesce(given.cast("string"), F.lit(""))))
    return F.coalesce(*(F.when(text.isin(names), F.lit(label)) for label, names in STATUS_GIVEN.items()), _first(preface, STATUS_WORDS, "effective"))


def document_role(title) -> Column:
    """reply, request, shell or substantive, by a title without white space."""
    return _first(F.regexp_replace(title, r"(?U)\s+", ""), ROLE_WORDS, "substantive")


def revision_event(description) -> Column:
    return _first(description, EVENT_WORDS, "other")


def is_yes(answer) -> Column:
    """Whether an answer, as text or boolean, means yes; null is no."""
    return F.coalesce(F.lower(stripped(answer.cast("string"))).isin(YES), F.lit(False))


def prompt_id(value) -> Column:
    """The whole number a text is; null for anything else."""
    text = stripped(value.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def heuristic_prediction(text) -> Column:
    """(interprets, score) by words alone: words of a legal basis come before words of a meaning."""
    made = lambda yes, score: F.struct(F.lit(yes).alias("interprets"), F.lit(score).alias("score"))
    return F.when(has_any(text, BASIS_WORDS), made(False, 0.12)).when(has_any(text, MEANING_WORDS), made(True, 0.82)).otherwise(made(False, 0.18))


def keyword_filter(words, most: int = 10) -> Column:
    """The first `most` distinct trimmed words of 2 to 10 letters that are no stop words; null gives an empty array."""
    trimmed = F.array_distinct(F.transform(F.coalesce(words, F.array().cast("array<string>")), stripped))
    return F.slice(F.filter(trimmed, lambda w: F.char_length(w).between(2, 10) & ~w.isin(STOP_KEYWORDS)), 1, most)


def cited_penalty(score, name, cited, factor: float = 0.7) -> Column:
    """score, lowered where the name holds one of the cited titles (an array; empty titles do not count)."""
    hit = F.exists(F.coalesce(cited, F.array().cast("array<string>")), lambda x: (x != "") & F.contains(name, x))
    return F.when(F.coalesce(hit, F.lit(False)), score * F.lit(factor)).otherwise(score)


def append_id(ids, new) -> Column:
    """A JSON array of texts with `new` at its end unless it is in it; what is no such array counts as empty."""
    have = F.coalesce(F.from_json(ids, "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.when(F.array_contains(have, new), have).otherwise(F.concat(have, F.array(new))))


def document_title(c) -> Column:
    """The title in 《》, which are not put twice; empty stays empty."""
    t = stripped(c)
    return F.when((t == "") | (F.startswith(t, F.lit("《")) & F.endswith(t, F.lit("》"))), t).otherwise(F.concat(F.lit("《"), t, F.lit("》")))


def file_title(c) -> Column:
    """A title that every file system takes; never empty."""
    safe = F.regexp_replace(stripped(c), r'[<>:"/\\|?*\x00-\x1f]', "_")
    safe = F.regexp_replace(stripped(F.regexp_replace(safe, r"(?U)\s+", " ")), "[. ]+$", "")
    return F.when(safe == "", "untitled").otherwise(safe)


def first_bytes(text: str, most: int) -> Column:
    """The longest start of a text (a column's name) in `most` bytes of UTF-8; a cut one loses blanks and full stops at its end."""
    # a letter has up to four bytes, so one of four cuts falls between letters
    cuts = ", ".join(f"try_validate_utf8(cast(substring(encode({text}, 'utf-8'), 1, {max(most - k, 0)}) AS string))" for k in range(4))
    return F.expr(f"if(octet_length({text}) <= {most}, {text}, regexp_replace(coalesce({cuts}), '[. ]+$', ''))")
