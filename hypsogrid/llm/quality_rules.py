"""Quality rules as a ledger of failure bits: every rule is evaluated once, policies are masks over the bits.

`ledger` adds the measurements and `fail_bits`; `apply_policy` turns bits into a verdict under a named version;
`ablation` tells from counts of bit patterns what each rule decides alone. All are built-in expressions.

Words are runs of characters other than space and \\x09-\\x0D.

Edge cases: a NULL or empty text has no words and fails `few_words`; NULL in other columns does not matter;
repeated rows are judged one by one; an empty table gives an empty ledger and zeros in the ablation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rule k sets bit k. Integer arithmetic only, so that any engine gives the same bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "duplicate_lines": "n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines",
    "capitals": "2 * n_upper > word_chars",
    "exclamation": "10 * n_exclamations > 3 * n_words",
}
#: The rules that fail a document whatever the policy.
BASE = ("few_words", "repeated_words")
#: A policy is the rules that count. Old versions stay, so old verdicts can be had again from a kept ledger.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "capitals"),
    "v3": tuple(RULES),
}
CURRENT = "v3"


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns as the output of a generator of one row: the optimiser does not copy their expressions into
    the places that use them, where a lambda or a filter would evaluate them again for every element."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def _measured(df: DataFrame, text: str) -> DataFrame:
    """Adds the measurements. Three-word windows are told apart by a 64-bit hash of their words."""
    df = _computed(df, {"_t": F.coalesce(F.col(text), F.lit(""))})
    t = F.col("_t")
    df = _computed(df, {
        "_w": F.expr(r"filter(split(_t, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"),
        "_l": F.expr(r"filter(split(_t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"),
        "_chars": F.length(t),
        "word_chars": _without(t, _SPACE).cast("long"),
    })
    df = _computed(df, {
        "n_words": F.size("_w").cast("long"),
        "n_symbols": (F.col("_chars") - _without(t, _SYMBOLS)).cast("long"),
        "n_upper": (F.col("_chars") - _without(t, _UPPER)).cast("long"),
        "n_exclamations": (F.col("_chars") - _without(t, "!")).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_h": F.expr("transform(slice(_w, 1, greatest(size(_w) - 2, 0)), (x, i) -> xxhash64(x, _w[i + 1], _w[i + 2]))"),
    })
    # Equal windows are neighbours once sorted; most texts have none and skip the sort.
    df = _computed(df, {"_s": F.expr(
        "case when size(array_distinct(_h)) < size(_h) then sort_array(transform(_h, (h, i) -> struct(h as h, i as i))) end"
    )})
    df = _computed(df, {"_p": F.expr(
        "sort_array(transform(filter(_s, (s, j) -> (j > 0 and _s[j - 1].h = s.h) or (j + 1 < size(_s) and _s[j + 1].h = s.h)), s -> s.i))"
    )})
    # A repeated window covers three words, or as many as lie before the next repeated one.
    df = _computed(df, {"n_repeat_words": F.expr(
        "coalesce(aggregate(transform(_p, (p, j) -> case when j + 1 < size(_p) then least(3, _p[j + 1] - p) else 3 end), 0L, (a, x) -> a + x), 0L)"
    )})
    return df.drop("_t", "_w", "_l", "_chars", "_h", "_s", "_p")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_exclamations", "n_lines", "n_dup_lines", "n_repeat_words")


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """df with `measures` (a struct), `fail_bits` and nothing else added; clashing names of df are replaced."""
    held = [F.col(c) for c in df.columns if c not in ("measures", "fail_bits")]
    inner = df.select(F.struct(*held).alias("_row"), F.col(text).alias("_text"))
    m = _measured(inner, "_text")
    bits = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())), F.lit(0))
    return m.select("_row.*", F.struct(*MEASURES).alias("measures"), bits.cast("long").alias("fail_bits"))


def apply_policy(kept_ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds `base_failed` and `kept` under a policy version."""
    fails = lambda rules: F.col("fail_bits").bitwiseAND(F.lit(mask(rules)).cast("long")) != 0
    return kept_ledger.withColumns({"base_failed": fails(BASE), "kept": ~fails(tuple({*BASE, *POLICIES[version]}))})


def ablation(kept_ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail only it (and would be kept without it), what is
    left with all rules, and the bits of all rules that fail together with it.

    Bit patterns are counted first: at most 2**rules rows, whatever the input.
    """
    rules = POLICIES[version]
    all_bits = F.lit(mask(rules)).cast("long")
    patterns = kept_ledger.groupBy(F.col("fail_bits").bitwiseAND(all_bits).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    bit = {r: F.lit(mask((r,))).cast("long") for r in rules}
    counted = patterns.agg(  # one row, of an empty ledger too
        total(F.col("bits") == 0).alias("n_kept"),
        F.array(*(F.struct(
            F.lit(r).alias("rule"), total(F.col("bits").bitwiseAND(bit[r]) != 0).alias("n_failed"), total(F.col("bits") == bit[r]).alias("n_only"),
            F.coalesce(F.bit_or(F.when(F.col("bits").bitwiseAND(bit[r]) != 0, F.col("bits"))), F.lit(0).cast("long")).alias("failed_with"),
        ) for r in rules)).alias("each"),
    ).select("n_kept", F.inline("each"))
    return counted.select("rule", "n_failed", "n_only", (F.col("n_kept") + F.col("n_only")).alias("n_kept_without"), "n_kept", "failed_with")


def judge_documents(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    judged = apply_policy(ledger(docs.select("doc_id", "text")), version)
    return judged.select(
        "doc_id", "measures.n_words", "measures.word_chars", "measures.n_symbols", "measures.n_dup_lines",
        "measures.n_repeat_words", "base_failed", "kept", "fail_bits",
    )


def keep_passing(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """docs without those that fail the policy, with their own columns only."""
    held = docs.select(F.struct("*").alias("_doc"), F.col("text").alias("text"))
    return apply_policy(ledger(held), version).where("kept").select("_doc.*")


ORACLE = r"""with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
a as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
w as (select rid, unnest(ws) as x, generate_subscripts(ws, 1) as i from a),
v as (select rid, i, x as x0, lead(x) over (partition by rid order by i) as x1, lead(x, 2) over (partition by rid order by i) as x2 from w),
f as (select rid, i from (select rid, i, count(*) over (partition by rid, x0, x1, x2) as n from v where x2 is not null) where n > 1),
r as (select rid, count(*) as n from (select distinct rid, i + k as i from f, (values (0), (1), (2)) as o(k)) group by rid),
m as (select doc_id, cast(len(ws) as bigint) as n_words,
  cast(length(translate(t, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)), '')) as bigint) as word_chars,
  cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
  length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as n_upper, length(t) - length(replace(t, '!', '')) as n_exclamations,
  len(ls) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from a left join r using (rid)),
b as (select *, (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
  + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when word_chars < 2 * n_words then 8 else 0 end)
  + (case when word_chars > 20 * n_words then 16 else 0 end) + (case when n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines then 32 else 0 end)
  + (case when 2 * n_upper > word_chars then 64 else 0 end) + (case when 10 * n_exclamations > 3 * n_words then 128 else 0 end) as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  bits = 0 as kept, cast(bits as bigint) as fail_bits from b"""
