"""Quality rules by distribution divergence, in DataFrame functions only.

Each document gets two histograms: characters by class, and the words of its
language's common-word list against all others. They are compared with the
reference of its language by Jensen-Shannon distance (base 2, so 0 to 1). The
reference is the pooled histogram of the documents of that language which
reach the length guard, counted over the whole corpus, and fitted once more
over those that the first references keep.

Defined results:

* null or blank text: no words, which is a base failure, so not kept;
* null or unknown language: only the class histogram is judged, against the
  pool of all documents whose language is null or has no word list of its own;
* shorter than a guard: that histogram is not judged and can not reject;
* a language without any document over the guard has no reference: not judged;
* repeated rows: each row is judged alone, with the same result;
* other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import pick, stage

# Very common words of each language.
COMMON_WORDS: dict[str, list[str]] = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that it for was on as with be by this are at from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour dans qui par sur au avec pas".split(),
}
N_COMMON = 20
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CLASSES = ["upper", "other_letter", "space", "digit", "symbol", "other"]


@dataclass(frozen=True)
class QualityParams:
    """Thresholds of the rules. ``max_class_js`` / ``max_word_js``: largest
    distance that is kept. ``min_class_chars`` / ``min_word_words``: length
    guards under which a histogram is too noisy to be judged."""

    min_words: int = 10
    max_repeat_pct: int = 20
    max_class_js: float = 0.18
    max_word_js: float = 0.31
    min_class_chars: int = 200
    min_word_words: int = 60


def _removed(text: Column, left: Column) -> Column:
    return F.char_length(text) - F.char_length(left)


def with_features(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` and the arrays ``class_hist`` and ``word_hist`` (counts).

    Column names starting with ``_q_`` are used inside and dropped."""
    t = F.col("_q_text")
    df = df.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_q_trim", F.btrim(t, F.lit(SPACE)))
    words = F.when(F.col("_q_trim") == "", F.array().cast("array<string>")).otherwise(
        F.split("_q_trim", "[ \\t-\\r]+"))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    common = F.create_map(*[x for k, v in COMMON_WORDS.items()
                            for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    df = df.withColumns({
        "_q_words": words,
        "_q_lines": lines,
        "_q_list": F.try_element_at(common, F.coalesce(F.col(lang), F.lit(""))),
        "word_chars": F.char_length(F.regexp_replace(t, "[ \\t-\\r]+", "")).cast("long"),
        "n_symbols": _removed(t, F.translate(t, SYMBOLS, "")).cast("long"),
        "_q_upper": _removed(t, F.regexp_replace(t, "\\p{Lu}+", "")),
        "_q_digit": _removed(t, F.regexp_replace(t, "\\p{Nd}+", "")),
        "_q_rest": F.char_length(F.regexp_replace(t, "[\\p{L} \\t-\\r]+", "")),
        "_q_len": F.char_length(t),
    })
    w = F.col("_q_words")
    df = df.withColumns({
        "n_words": F.size(w).cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "_q_windows": F.when(F.size(w) >= 5, F.transform(
            F.sequence(F.lit(0), F.size(w) - 5),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(5)]))),
        "_q_common": F.filter(w, lambda x: F.array_contains(F.col("_q_list"), x)),
    })
    # Only texts with a repeated window pay for finding where it stands.
    h = F.col("_q_windows")
    df = df.withColumn("_q_sorted", F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("_q_sorted")
    df = df.withColumn("_q_pos", F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))
                 | F.coalesce((i > 0) & (x["h"] == F.get(s, i - 1)["h"]), F.lit(False))),
        lambda x: x["i"])))
    p = F.col("_q_pos")
    # Words from each place to the next, five at most; the last place has no next.
    covered = F.aggregate(
        F.zip_with(F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), p,
                   lambda b, a: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5))),
        F.lit(0), lambda acc, x: acc + x)
    hist = F.transform(F.col("_q_list"), lambda x: F.size(F.filter("_q_common", lambda y: y == x)))
    df = df.withColumns({
        "n_repeat_words": F.when(F.size(p) > 0, covered).otherwise(0).cast("long"),
        "class_hist": F.array(
            F.col("_q_upper"), F.col("_q_len") - (F.col("_q_len") - F.col("word_chars")) - F.col("_q_rest") - F.col("_q_upper"),
            F.col("_q_len") - F.col("word_chars"), F.col("_q_digit"), F.col("n_symbols"),
            F.col("_q_rest") - F.col("_q_digit") - F.col("n_symbols")).cast("array<long>"),
        "word_hist": F.concat(hist, F.array(F.size(w) - F.size("_q_common"))).cast("array<long>"),
    })
    return df.drop(*[c for c in df.columns if c.startswith("_q_")])


def _js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence of two count arrays, each
    normalised to sum 1. Null where one of them is null or all zero."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    both = F.zip_with(p, q, lambda a, b: F.struct((a / F.nullif(total(p), F.lit(0.0))).alias("a"),
                                                  (b / F.nullif(total(q), F.lit(0.0))).alias("b")))
    div = F.aggregate(both, F.lit(0.0), lambda acc, x: acc + (
        part(x["a"], (x["a"] + x["b"]) / 2) + part(x["b"], (x["a"] + x["b"]) / 2)) / 2)
    return F.sqrt(F.greatest(div, F.lit(0.0)))


def _ref_key(lang: Column) -> Column:
    """The language whose reference is used; empty for those without a list."""
    return F.when(lang.isin(list(COMMON_WORDS)), lang).otherwise("")


def references(features: DataFrame, params: QualityParams = QualityParams(), lang: str = "lang") -> DataFrame:
    """One row per language with a word list, and one for all others: the
    pooled histograms of its documents over the guards. At most
    ``len(COMMON_WORDS) + 1`` rows, so this table is always small."""
    over = {"class": F.col("n_chars_seen") >= params.min_class_chars, "word": F.col("n_words") >= params.min_word_words}
    f = features.withColumn("n_chars_seen", F.aggregate("class_hist", F.lit(0).cast("long"), lambda a, v: a + v))
    sizes = {"class": len(CLASSES), "word": N_COMMON + 1}
    sums = [F.sum(F.when(over[k], F.get(f"{k}_hist", F.lit(i)))).alias(f"{k}_{i}") for k in sizes for i in range(sizes[k])]
    out = f.groupBy(_ref_key(F.col(lang)).alias("ref_lang")).agg(*sums)
    return out.select("ref_lang", *[
        F.when(F.col(f"{k}_0").isNotNull(), F.array(*[F.col(f"{k}_{i}") for i in range(n)])).alias(f"{k}_ref")
        for k, n in sizes.items()])


def with_verdict(features: DataFrame, refs: DataFrame, params: QualityParams = QualityParams(),
                 lang: str = "lang") -> DataFrame:
    """Adds ``class_js``, ``word_js``, ``base_failed`` and ``kept``."""
    refs = F.broadcast(refs)  # at most one row per word list, see references()
    df = features.join(refs, _ref_key(features[lang]) == refs["ref_lang"], "left")
    n = F.aggregate("class_hist", F.lit(0).cast("long"), lambda a, v: a + v)
    df = df.withColumns({
        "class_js": F.when(n >= params.min_class_chars, _js_distance(F.col("class_hist"), F.col("class_ref"))),
        "word_js": F.when(F.col("n_words") >= params.min_word_words, _js_distance(F.col("word_hist"), F.col("word_ref"))),
        "base_failed": (F.col("n_words") < params.min_words)
        | (100 * F.col("n_repeat_words") > params.max_repeat_pct * F.col("n_words")),
    })
    far = (F.coalesce(F.col("class_js"), F.lit(0.0)) > params.max_class_js) | (
        F.coalesce(F.col("word_js"), F.lit(0.0)) > params.max_word_js)
    return df.withColumn("kept", ~F.col("base_failed") & ~far).drop("ref_lang", "class_ref", "word_ref")


def fitted_references(features: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """References fitted in two steps on the written counts: once over all
    documents, then over those which the first references keep, so that junk
    does not shape what it is measured against."""
    first = stage(references(features, params), "quality-refs")
    return stage(references(with_verdict(features, first, params).filter("kept"), params), "quality-refs")


def quality_rules(documents: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """A row per document: ``doc_id``, the counts, both distances and the
    verdict. The texts are read once; references and verdicts come from the
    written counts."""
    docs = pick(documents, doc_id="doc_id", text="text", lang="lang")
    feats = stage(with_features(docs).drop("text"), "quality")
    return with_verdict(feats, fitted_references(feats, params), params).drop("lang")


def keep_good(documents: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their own columns.

    The texts are read and counted once; rows and counts are written together,
    as the verdict needs the references of the whole corpus. Nothing but the
    histograms is shuffled."""
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_doc"), "text", "lang")
    rows = stage(with_features(own).drop("text"), "quality-rows")
    return with_verdict(rows, fitted_references(rows.drop("_doc"), params), params).filter("kept").select("_doc.*")


def _sql_js(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts, in DuckDB SQL."""
    a, b = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
    term = "CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({a} + {b})) ELSE 0 END"
    both = f"{term.format(x=a, a=a, b=b)} + {term.format(x=b, a=a, b=b)}"
    return f"sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: {both})) / 2, 0))"


def oracle_sql(params: QualityParams = QualityParams()) -> str:
    """The rows of the registered query in DuckDB SQL."""
    space = r"[ \t\n\x0b\x0c\r]+"
    lists = " ".join(f"WHEN '{k}' THEN [" + ", ".join(f"'{w}'" for w in v) + "]" for k, v in COMMON_WORDS.items())
    known = ", ".join(f"'{k}'" for k in COMMON_WORDS)
    n = {"c": len(CLASSES), "w": N_COMMON + 1}

    def refs(name: str, rows: str) -> str:
        cols = ", ".join("[" + ", ".join(f"sum({k}[{i}]) FILTER ({k}_ok)" for i in range(1, n[k] + 1)) + f"] AS {k}_ref" for k in n)
        return f"{name} AS (SELECT ref_lang, {cols} FROM {rows} GROUP BY ref_lang)"

    def verdict(name: str, ref: str) -> str:
        return f"""{name} AS (SELECT h.*, NOT base_failed
            AND coalesce(CASE WHEN c_ok THEN {_sql_js('c', 'c_ref')} END, 0) <= {params.max_class_js}
            AND coalesce(CASE WHEN w_ok THEN {_sql_js('w', 'w_ref')} END, 0) <= {params.max_word_js} AS kept
          FROM h LEFT JOIN {ref} r ON r.ref_lang = h.ref_lang)"""

    return rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{space}'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT doc_id, p, array_to_string(words[p : p + 4], ' ') AS s
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM d WHERE len(words) >= 5)),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT g.doc_id, unnest(range(g.p, g.p + 5)) AS q FROM g
    JOIN (SELECT doc_id, s FROM g GROUP BY doc_id, s HAVING count(*) > 1) twice ON twice.doc_id = g.doc_id AND twice.s = g.s) GROUP BY doc_id),
f AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{space}', '', 'g'))::BIGINT AS word_chars,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS up,
         length(t) - length(regexp_replace(t, '\p{{Nd}}+', '', 'g')) AS dg,
         length(regexp_replace(t, '[\p{{L}} \t\n\x0b\x0c\r]+', '', 'g')) AS rest, length(t) AS len,
         CASE WHEN lang IN ({known}) THEN lang ELSE '' END AS ref_lang,
         list_transform(CASE lang {lists} END, lambda c: len(list_filter(words, lambda x: x = c))) AS wh
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS lines FROM d) d
  LEFT JOIN rep ON rep.doc_id = d.doc_id),
h AS (
  SELECT doc_id, n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, ref_lang,
         n_words < {params.min_words} OR 100 * n_repeat_words > {params.max_repeat_pct} * n_words AS base_failed,
         [up, word_chars - rest - up, len - word_chars, dg, n_symbols, rest - dg - n_symbols]::DOUBLE[] AS c,
         (wh || [n_words - list_sum(wh)])::DOUBLE[] AS w,
         len >= {params.min_class_chars} AS c_ok, wh IS NOT NULL AND n_words >= {params.min_word_words} AS w_ok
  FROM f),
{refs('r1', 'h')}, {verdict('v1', 'r1')}, {refs('r2', '(SELECT * FROM v1 WHERE kept)')}, {verdict('v2', 'r2')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM v2
"""
