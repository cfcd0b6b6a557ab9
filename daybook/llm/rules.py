"""Quality rules as a short-circuit cascade, in Spark SQL expressions only.

Every rule is a condition over measures of the whole text. A sample of bounded size gives each rule's cost (time of a warm run over the
sample, less that of a run that only cuts the text into words) and the share it rejects; the cascade then tries rules by rejection per cost, so
that most rejected documents pay for one cheap rule and the dear measures are taken of the others only. The order never changes a verdict.

A text is cut into words once: the words are bound by a ``transform`` over an array that holds nothing else, and all measures of the cascade are
taken of them within one CASE, each only when its rule is reached.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import settle

SPACE = "[\\\\x20\\\\x09-\\\\x0D]"  # as a SQL literal
SAMPLE_ROWS = 2_000

#: Measure -> SQL over the text ``t`` (not null) and its words ``w``. The word triples of a text are hashed, a triple's place fills the
#: low bits of its hash, and sorting brings equal triples together; whole hashes are compared, so the cut of the high bits decides
#: nothing. Each start of a repeated triple then covers three words less those that the start before it covers.
_WORDS = f"array_remove(split(t, '{SPACE}+'), '')"
_REPEAT = """
if(size(w) < 3, 0L,
  transform(array(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))), h ->
    if(size(array_distinct(h)) = size(h), 0L,
      transform(array(named_struct('bits', cast(ceil(log2(size(h) + 1)) as int), 'low', shiftleft(1L, cast(ceil(log2(size(h) + 1)) as int)) - 1)), b ->
        transform(array(sort_array(transform(h, (x, i) -> shiftleft(x, b.bits) | i))), s ->
          aggregate(
            sort_array(filter(transform(s, (x, k) -> if(
              (k > 0 and h[cast(x & b.low as int)] = h[cast(s[greatest(k - 1, 0)] & b.low as int)])
              or (k < size(s) - 1 and h[cast(x & b.low as int)] = h[cast(s[least(k + 1, size(s) - 1)] & b.low as int)]),
              x & b.low, -1L)), p -> p >= 0)),
            named_struct('words', 0L, 'last', -3L),
            (a, p) -> named_struct('words', a.words + least(3L, p - a.last), 'last', p),
            a -> a.words))[0])[0]))[0])"""

MEASURES = {
    "n_words": "cast(size(w) as bigint)",
    "word_chars": "cast(length(array_join(w, '')) as bigint)",
    "n_symbols": "cast(regexp_count(t, '[#*$%&|<>]') as bigint)",
    "n_dup_lines": f"""transform(array(filter(split(t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')),
                       l -> cast(size(l) - size(array_distinct(l)) as bigint))[0]""",
    "n_repeat_words": _REPEAT,
    "n_lines": f"cast(size(filter(split(t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')) as bigint)",
    "n_capitals": "cast(regexp_count(t, '[A-Z]') as bigint)",
    "longest_word": "cast(coalesce(array_max(transform(w, x -> length(x))), 0) as bigint)",
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rule -> condition that rejects, over measures in braces.
RULES = {
    "few_words": "{n_words} < 50",
    "repeated_words": "100 * {n_repeat_words} > 50 * {n_words}",
    "symbols": "100 * {n_symbols} > 20 * {n_words}",
    "repeated_lines": "100 * {n_dup_lines} > 50 * {n_lines}",
    "capitals": "100 * {n_capitals} > 60 * {word_chars}",
    "word_length": "{word_chars} < 2 * {n_words} or {word_chars} > 15 * {n_words}",
    "endless_word": "{longest_word} > 1000",
}
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Estimate:
    rule: str
    cost: float  # seconds over the sample
    rejects: float  # share of the sample

    @property
    def rank(self) -> float:
        return self.rejects / max(self.cost, 1e-6)


def _bound(text_col: str, body: str) -> str:
    """SQL that takes ``body`` over the text ``t`` of a column (null: empty) and its words ``w``."""
    quoted = text_col.replace("`", "``")
    return f"transform(array(coalesce(`{quoted}`, '')), t -> transform(array({_WORDS}), w -> {body})[0])[0]"


def estimate(docs: DataFrame, text_col: str = "text", rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> list[Estimate]:
    """Cost and selectivity of each rule on about ``sample_rows`` documents.

    Null texts count as empty ones, repeated rows as often as they occur. On an empty table every rule costs the least and rejects nothing.
    """
    rows = docs.count()
    text = F.col(text_col).alias("text")
    drawn = docs.select(text) if rows <= sample_rows else docs.select(text).sample(fraction=sample_rows / rows, seed=seed)
    sample = settle(drawn.coalesce(4))
    size = max(1, sample.count())

    def run(condition: str) -> tuple[float, int]:
        test = sample.agg(F.count(F.when(F.expr(_bound("text", condition)), 1)))
        took = []
        for _ in range(2):  # the first run warms up
            start = time.perf_counter()
            rejected = test.first()[0]
            took.append(time.perf_counter() - start)
        return took[-1], rejected

    idle = run("size(w) < 0")[0]
    found = []
    for name, condition in rules.items():
        seconds, rejected = run(condition.format(**MEASURES))
        found.append(Estimate(name, max(seconds - idle, 1e-3), rejected / size))
    return found


def ordered(estimates: list[Estimate]) -> list[str]:
    """Rules by rejection per cost, the best first; equals by cost, then by name."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.rank, e.cost, e.rule))]


def cascade(order: list[str], measures: dict[str, str] = MEASURES, rules: dict[str, str] = RULES) -> str:
    """SQL for the first rule that rejects, null for a kept document. A condition is evaluated only if all before it fail."""
    whens = " ".join(f"when {rules[name].format(**measures)} then '{name}'" for name in order)
    return f"case {whens} end" if whens else "cast(null as string)"


def first_rejecting(order: list[str], text_col: str = "text", rules: dict[str, str] = RULES) -> Column:
    return F.expr(_bound(text_col, cascade(order, rules=rules)))


def keep_passing(docs: DataFrame, text_col: str = "text", rules: dict[str, str] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are, whatever their names.

    A null text counts as an empty one and has too few words. Repeated rows are judged each; an empty table gives an empty result. Of rules that rank equal the
    one that costs less is tried first, then the first by name; without rules every row passes.
    """
    return docs.filter(first_rejecting(ordered(estimate(docs, text_col, rules)), text_col, rules).isNull())


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measures of BASE, base_failed and kept per row of ``docs``.

    Null and blank texts measure 0 and fail. Repeated rows are measured each; other columns are not read; an empty table gives an
    empty result. What only the verdict needs is measured within the cascade, of documents that get there.
    """
    order = ordered(estimate(docs, text_col))
    taken = ", ".join(f"'{name}', {MEASURES[name]}" for name in BASE)
    known = {name: f"m.{name}" if name in BASE else sql for name, sql in MEASURES.items()}
    base = " or ".join(f"({RULES[name].format(**known)})" for name in BASE_RULES)
    body = (f"transform(array(named_struct({taken})), m -> named_struct({', '.join(f"'{n}', m.{n}" for n in BASE)}, 'base_failed', {base}, "
            f"'kept', {cascade(order, known)} is null))[0]")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.expr(_bound(text_col, body)).alias("r")).select(
        "doc_id", *(F.col(f"r.{name}").alias(name) for name in (*BASE, "base_failed", "kept")))


_SQL_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
ORACLE_SQL = rf"""
with texts as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
words as (select rid, unnest({_SQL_WORDS}) as w, generate_subscripts({_SQL_WORDS}, 1) as i from texts),
triples as (select rid, i, w, lead(w, 1) over o as w1, lead(w, 2) over o as w2 from words window o as (partition by rid order by i)),
starts as (select rid, i from (select rid, i, count(*) over (partition by rid, w, w1, w2) as n from triples where w2 is not null) where n > 1),
covered as (select rid, count(distinct i + k) as n from starts, (values (0), (1), (2)) v(k) group by rid),
lines as (select rid, l, count(*) as n from (select rid, unnest(string_split(t, chr(10))) as l from texts)
          where regexp_matches(l, '[^\x20\x09-\x0D]') group by rid, l),
repeats as (select rid, sum(n) as n_lines, sum(n - 1) as n_dup_lines from lines group by rid),
long_words as (select rid, max(length(w)) as longest, sum(length(w)) as chars, count(*) as n from words group by rid),
measures as (
  select doc_id, t, coalesce(x.n, 0)::bigint as n_words, coalesce(chars, 0)::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines, coalesce(longest, 0) as longest,
         len(regexp_extract_all(t, '[A-Z]')) as capitals
  from texts left join covered c using (rid) left join repeats using (rid) left join long_words x using (rid)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measures)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 20 * n_words or 100 * n_dup_lines > 50 * n_lines or 100 * capitals > 60 * word_chars
            or word_chars < 2 * n_words or word_chars > 15 * n_words or longest > 1000) as kept
from judged
"""
