"""Text repair, measures, tokens, TF-IDF and naive Bayes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lopside.functions import text as X
from lopside.operators import tfidf as V
from lopside.operators.splits import stratified_split
from lopside.queries.audits import FLAGGED
from lopside.queries.registry import query, r6, rounded
from lopside.sources.readers import message_lines, overflow_rows, repair_overflow

TOKENS = "regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# StopWordsRemover's list is read inside the JVM, so it is only known once a
# session runs; the SQL uses the words that can be a token at all.
STOP_SQL_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn
ma mightn mustn needn shan shouldn wasn weren won wouldn""".split()
STOPPED = f"list_filter({TOKENS}, lambda x: not list_contains({sql_list(STOP_SQL_WORDS)}, x))"


def stop_words() -> list[str]:
    """A fixed word list, as a parameter of the queries on both sides."""
    return STOP_SQL_WORDS


@query("training_text", "F01 F02 P21", sql="""
  select id, regexp_replace(title, '\\s*\\(.*\\)\\s*$', '') as title,
    length(concat(regexp_replace(title, '\\s*\\(.*\\)\\s*$', ''), ' . ', description)) as n_chars,
    md5(concat(regexp_replace(title, '\\s*\\(.*\\)\\s*$', ''), ' . ', description)) as text_md5 from genre""")
def _(t):
    text = X.build_text(F.col("title"), F.col("description"))
    return t.genre.select("id", X.strip_parenthetical(F.col("title")).alias("title"),
                          F.length(text).alias("n_chars"), F.md5(text).alias("text_md5"))


@query("stripped_texts", "S02 S11", sql="""
  select id, length(description) as n_chars, md5(description) as text_md5 from genre
  where description <> ''""")
def _(t):
    padded = t.genre.select("id", F.concat(F.lit(" \t "), "description", F.lit("\n  ")).alias("value"))
    out = message_lines(padded)
    return out.select("id", F.length("value").alias("n_chars"), F.md5("value").alias("text_md5"))


@query("repaired_messages", "F03 P11 P12 P07", sql="""
  with p as (select row_id, label, message, string_split(message, ',') as s from sms)
  select label, count(*) as cut_messages, cast(sum(case when length(message) > length(s[1]) then 1 else 0 end) as bigint)
    as repaired, cast(sum(length(message)) as bigint) as n_chars from p where len(s) > 1 group by label""")
def _(t):
    # Cut every message at its first comma, as the broken files are, and re-join it.
    parts = F.split("message", ",", 2)
    cut = t.sms.select("row_id", "label", parts[0].alias("v2"), F.try_element_at(parts, F.lit(2)).alias("_c2"))
    overflow = overflow_rows(cut, ["_c2"]).withColumn("raw", F.col("v2"))
    fixed = repair_overflow(overflow, "v2", ["_c2"])
    return fixed.groupBy("label").agg(
        F.count("*").alias("cut_messages"),
        F.sum(F.when(F.length("message") > F.length("raw"), 1).otherwise(0)).alias("repaired"),
        F.sum(F.length("message")).alias("n_chars"))


@query("text_measures", "F04 F05", sql=r"""
  select id, length(description) as n_chars,
    cast(len(list_filter(regexp_split_to_array(description, '\s+'), lambda x: x <> '')) as int) as n_words from genre""")
def _(t):
    return t.genre.select("id", F.length("description").alias("n_chars"), X.word_count(F.col("description")).alias("n_words"))


@query("shortened_texts", "F12", sql="""
  select id, case when length(description) > 200 then concat(left(description, 200), '...') else description end as shown
  from genre""")
def _(t):
    return t.genre.select("id", X.shorten(F.col("description"), 200).alias("shown"))


@query("unaccented_texts", "F18 F19", sql="""
  select id, length(strip_accents(lower(description))) as n_chars, md5(strip_accents(lower(description))) as text_md5
  from genre""")
def _(t):
    plain = X.strip_accents(F.lower("description"))
    return t.genre.select("id", F.length(plain).alias("n_chars"), F.md5(plain).alias("text_md5"))


def _term_summary(df, row_id="id"):
    return df.select(row_id, F.size("terms").alias("n_terms"), F.md5(F.array_join("terms", "|")).alias("terms_md5"))


def _term_sql(expression: str, table="genre", row_id="id") -> str:
    return f"""with w as (select {row_id}, {expression} as terms from {table})
  select {row_id}, cast(len(terms) as int) as n_terms, md5(array_to_string(terms, '|')) as terms_md5 from w"""


@query("word_tokens", "X01 F18", sql=_term_sql(TOKENS.format(c="description")))
def _(t):
    return _term_summary(X.with_terms(t.genre, "description"))


@query("words_without_stop_words", "X02", sql=_term_sql(STOPPED.format(c="description")))
def _(t):
    return _term_summary(X.with_terms(t.genre, "description", stop_words=stop_words()))


BIGRAMS = "list_concat({t}, list_transform(range(1, len({t})), lambda i: concat({t}[i], ' ', {t}[i + 1])))"


@query("word_bigrams", "X03", sql=f"""with w as (select id, {STOPPED.format(c='description')} as t from genre),
  b as (select id, {BIGRAMS.format(t='t')} as terms from w)
  select id, cast(len(terms) as int) as n_terms, md5(array_to_string(terms, '|')) as terms_md5 from b""")
def _(t):
    return _term_summary(X.with_terms(t.genre, "description", ngram_range=(1, 2), stop_words=stop_words()))


CHAR_WB = r"""flatten(list_transform(list_filter(regexp_split_to_array(lower({c}), '\s+'), lambda w: w <> ''),
    lambda w: flatten(list_transform(range(3, least(5, length(w) + 2) + 1),
      lambda n: list_transform(range(1, length(w) + 2 - n + 2), lambda i: substring(concat(' ', w, ' '), i, n))))))"""


@query("char_ngrams", "X04", sql=_term_sql(CHAR_WB.format(c="message"), "sms", "row_id"))
def _(t):
    return _term_summary(X.with_terms(t.sms, "message", analyzer="char_wb", ngram_range=(3, 5)), "row_id")


GENRE_TF = f"""
  w as (select id, genre, {STOPPED.format(c='description')} as t from genre),
  e as (select id, genre, unnest({BIGRAMS.format(t='t')}) as term from w),
  c as (select id, genre, term, count(*) as tf from e group by 1, 2, 3),
  v as (select term, count(*) as df from c group by 1 having count(*) >= 2)"""


def genre_vocabulary(t):
    return V.fitted_vocabulary(t.genre, "id", "description", 2, ngram_range=(1, 2), stop_words=stop_words())


@query("vocabulary", "X05", sql=f"with {GENRE_TF} select term, df from v")
def _(t):
    return genre_vocabulary(t)


@query("vocabulary_size", "X10 X05", sql=f"with {GENRE_TF} select count(*) as n_terms from v")
def _(t):
    return genre_vocabulary(t).agg(F.count("*").alias("n_terms"))


@query("tfidf_weights", "X06 X07 X08", sql=f"""with {GENRE_TF},
  r as (select id, term, tf, df, (1 + ln(tf)) * (ln((1 + (select count(*) from genre)) / (1 + df)) + 1) as raw
    from c join v using (term))
  select id, term, tf, df, round(raw / sqrt(sum(raw * raw) over (partition by id)), 6) as weight from r""")
def _(t):
    out = V.tfidf_long(t.genre, "id", "description", min_df=2, ngram_range=(1, 2), stop_words=stop_words())
    return out.select("id", "term", "tf", "df", r6("weight").alias("weight"))


@query("char_tfidf_norms", "X04 X06 X07 X08", sql=f"""
  with e as (select row_id, unnest({CHAR_WB.format(c='message')}) as term from sms_unique),
  c as (select row_id, term, count(*) as tf from e group by 1, 2),
  v as (select term, count(*) as df from c group by 1 having count(*) >= 2),
  r as (select row_id, tf, (1 + ln(tf)) * (ln((1 + (select count(*) from sms_unique)) / (1 + df)) + 1) as raw
    from c join v using (term))
  select row_id, count(*) as n_terms, cast(sum(tf) as bigint) as n_grams,
    round(max(raw) / sqrt(sum(raw * raw)), 6) as top_weight from r group by 1""")
def _(t):
    out = V.tfidf_long(t.sms_unique, "row_id", "message", min_df=2, analyzer="char_wb", ngram_range=(3, 5))
    return out.groupBy("row_id").agg(F.count("*").alias("n_terms"), F.sum("tf").alias("n_grams"),
                                     r6(F.max("weight")).alias("top_weight"))


@query("term_counts", "X09 X05 X02", sql=f"""
  with e as (select row_id, unnest({STOPPED.format(c='message')}) as term from sms_unique),
  c as (select row_id, term, count(*) as tf from e group by 1, 2),
  v as (select term from c group by 1 having count(*) >= 5)
  select row_id, term, tf from c semi join v using (term)""")
def _(t):
    return V.kept_counts(t.sms_unique, "row_id", "message", 5, stop_words=stop_words()).select("row_id", "term", "tf")


@query("tfidf_fitted_on_train", "X11 L03", sql=f"""with {FLAGGED},
  e as (select row_id, in_test, unnest({TOKENS.format(c='message')}) as term from flagged),
  c as (select row_id, in_test, term, count(*) as tf from e group by 1, 2, 3),
  v as (select term, count(*) as df from c where not in_test group by 1 having count(*) >= 2),
  r as (select row_id, term, tf, df,
    (1 + ln(tf)) * (ln((1 + (select count(*) from flagged where not in_test)) / (1 + df)) + 1) as raw
    from c join v using (term) where in_test)
  select row_id, term, tf, df, round(raw / sqrt(sum(raw * raw) over (partition by row_id)), 6) as weight from r""")
def _(t):
    train, test = stratified_split(t.sms, "label", "row_id", 0.2)
    out = V.tfidf_apply(train, test, "row_id", "message", min_df=2)
    return out.select("row_id", "term", "tf", "df", r6("weight").alias("weight"))


@query("term_contrast", "X12 A27 K04 X09", sql=f"""
  with e as (select row_id, label, unnest({STOPPED.format(c='message')}) as term from sms_unique),
  c as (select row_id, label, term, count(*) as tf from e group by 1, 2, 3),
  n as (select count(*) filter (label = 'spam') as p, count(*) filter (label <> 'spam') as q from sms_unique),
  f as (select term, count(*) as df, coalesce(sum(tf) filter (label = 'spam'), 0) / max(n.p) as freq_pos,
    coalesce(sum(tf) filter (label <> 'spam'), 0) / max(n.q) as freq_neg from c, n group by term having count(*) >= 5),
  r as (select *, (freq_pos + 1e-6) / (freq_neg + 1e-6) as ratio from f),
  k as (select *, row_number() over (order by ratio desc, term) as a, row_number() over (order by ratio, term) as b from r)
  select term, df, round(freq_pos, 6) as freq_pos, round(freq_neg, 6) as freq_neg, round(ratio, 4) as ratio, 1 as side
  from k where a <= 15
  union all select term, df, round(freq_pos, 6), round(freq_neg, 6), round(ratio, 4), -1 from k where b <= 15""")
def _(t):
    out = V.term_contrast(t.sms_unique, "row_id", "message", "label", "spam", 15, 5, stop_words=stop_words())
    return out.select("term", "df", r6("freq_pos").alias("freq_pos"), r6("freq_neg").alias("freq_neg"),
                      F.round("ratio", 4).alias("ratio"), "side")


@query("naive_bayes_scores", "M01 X09 M08", sql=f"""with {FLAGGED},
  e as (select row_id, label, in_test, unnest({TOKENS.format(c='message')}) as term from flagged),
  tr as (select label, term, count(*) as c from e where not in_test group by 1, 2),
  vocab as (select distinct term from tr),
  tot as (select label, sum(c) as total from tr group by 1),
  pri as (select label, count(*) as n from flagged where not in_test group by 1),
  te as (select row_id, term, count(*) as tf from e where in_test and term in (select term from vocab) group by 1, 2),
  cls as (select label, ln(n / (select sum(n) from pri)) as prior, total + (select count(*) from vocab) as den
    from pri join tot using (label)),
  s as (select te.row_id, cls.label, sum(tf * (ln(coalesce(tr.c, 0) + 1) - ln(den))) as ll
    from te cross join cls left join tr on tr.term = te.term and tr.label = cls.label group by 1, 2)
  select f.row_id, cls.label, round(prior + coalesce(ll, 0), 4) as score
  from flagged f cross join cls left join s on s.row_id = f.row_id and s.label = cls.label where f.in_test""")
def _(t):
    train, test = stratified_split(t.sms, "label", "row_id", 0.2)
    out = V.naive_bayes_long(train, test, "row_id", "message", "label")
    return out.select("row_id", "label", F.round("score", 4).alias("score"))


@query("message_measures", "N02", sql=r"""
  select row_id, length(message) as n_chars, cast(len(regexp_extract_all(message, '[0-9]')) as int) as n_digits,
    round(case when length(message) > 0 then len(regexp_extract_all(message, '[0-9]')) / length(message) else 0 end, 6)
      as digit_ratio,
    cast(len(regexp_extract_all(message, '[A-Z]{2,}')) as int) as uppercase_runs,
    cast(regexp_matches(message, '(?i)(https?://|www\.)') as int) as has_url,
    cast(regexp_matches(message, '[0-9]{5,}') as int) as has_long_number from sms""")
def _(t):
    return rounded(t.sms.select("row_id", *[c.alias(n) for n, c in X.message_measures(F.col("message")).items()]))
