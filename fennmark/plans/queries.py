"""Every query of the library over the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fennmark.functions import text as T
from fennmark.operators import catalogue, corpus, dialogue, postings, retrieval, routing, temporal, usage
from fennmark.plans import samples
from fennmark.session import kept, table, work_folder
from fennmark.sources import catalogue as reader
from fennmark.sources import typed
from fennmark.streaming import events as streams
from fennmark.streaming import stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
ROUTES = {"articles": ["the", "a", "an"], "links": ["and", "or", "und", "et"], "places": ["in", "on", "at", "en"]}
WORDS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _values(text: str) -> str:
    return "(values " + ", ".join("('" + x.replace("'", "''") + "')" for x in text.split("\n")) + ") t(value)"


TABLE_SQL = f"""select cast(c[1] as int) seq, nullif(regexp_extract(c[2], '[🎯✅]'), '') marker, trim(regexp_replace(c[2], '[🎯✅]', '', 'g')) name_en, c[3] name_zh,
  cast(string_split(c[4], '.')[2] as int) as year, cast(string_split(c[4], '.')[1] as int) rev
from (select list_transform(string_split(regexp_replace(trim(value), '^\\||\\|+$', '', 'g'), '|'), lambda x: trim(x)) c from {_values(samples.TABLE)}) where regexp_matches(c[1], '^[0-9]+$')"""
LINKED_SQL = f"""select cast(c[1] as int) seq, regexp_extract(c[2], '\\[(.+)\\]\\(', 1) name_en, regexp_extract(c[2], '\\]\\(([^()]+)\\)', 1) url,
  cast(regexp_extract(c[2], 'id=([0-9]+)', 1) as int) guide_id, cast(string_split(c[3], '.')[2] as int) as year, cast(string_split(c[3], '.')[1] as int) rev, c[4] name_zh
from (select list_transform(string_split(regexp_replace(trim(value), '^\\||\\|+$', '', 'g'), '|'), lambda x: trim(x)) c from {_values(samples.LINKED)}) where regexp_matches(c[1], '^[0-9]+$')"""


@query("c1_catalogue_table", TABLE_SQL)
def c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.parse_table(samples.lines(spark, samples.TABLE))


@query("c1_linked_table", LINKED_SQL)
def c1_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.parse_linked_table(samples.lines(spark, samples.LINKED))


BLOCKS_SQL = f"""with b as (select unnest(regexp_extract_all('{samples.BLOCKS}', '\\[[^\n]+\\]\\([^()\n]+\\)\\s+Version: [0-9.]+')) b, unnest(generate_series(1, 9)) pos)
select cast(pos as int) pos, regexp_extract(b, '^\\[(.+)\\]\\(', 1) name_en, regexp_extract(b, '\\]\\(([^()]+)\\)', 1) url, cast(regexp_extract(b, 'id=([0-9]+)', 1) as int) guide_id,
  cast(regexp_extract(b, 'Version: [0-9]+[.]([0-9]+)', 1) as int) as year, cast(regexp_extract(b, 'Version: ([0-9]+)', 1) as int) rev from b where b is not null"""


@query("c2_block_list", BLOCKS_SQL)
def c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.parse_blocks(samples.lines(spark, samples.BLOCKS, whole=True))


@query("c3_url_parts", "select page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) host, try_cast(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as int) page from pages")
def c3(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", T.url_host(url).alias("host"), T.url_parameter(url, "page").try_cast("int").alias("page"))


BOTH_SQL = f"select name_en, year, rev from ({TABLE_SQL}) union all select name_en, year, rev from ({LINKED_SQL})"


@query("c4_latest_version", f"select name_en, cast(max(year * 1000 + rev) // 1000 as int) as year, cast(max(year * 1000 + rev) % 1000 as int) as rev from ({BOTH_SQL}) group by name_en")
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["name_en", "year", "rev"]
    return catalogue.latest_versions(c1(spark, sf_dir).select(columns).unionByName(c1_linked(spark, sf_dir).select(columns)))


@query(
    "c5_reconcile",
    f"""select coalesce(a.name_en, b.name_en) name_en, case when b.name_en is null then 'only_a' when a.name_en is null then 'only_b' when a.year = b.year and a.rev = b.rev then 'same' else 'conflict' end status,
  a.year year_a, a.rev rev_a, b.year year_b, b.rev rev_b from ({TABLE_SQL}) a full join ({LINKED_SQL}) b on a.name_en = b.name_en""",
)
def c5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.reconcile(c1(spark, sf_dir), c1_linked(spark, sf_dir))


@query("c6_missing_entries", "select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def c6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.missing_from(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("c6_unlabelled_mix", "select lang, source from documents except all select lang, source from documents join labels using (doc_id)")
def c6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return catalogue.left_over(docs.select("lang", "source"), docs.join(table(spark, sf_dir, "labels"), "doc_id").select("lang", "source"))


@query("c7_facets", "select lang, source, count(*) n from documents group by lang, source")
def c7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.facets(table(spark, sf_dir, "documents"), "lang", "source")


@query("c8_control_totals", f"""with s as (select cast(sum(cast(x as bigint)) as bigint) stated from (select unnest(regexp_extract_all('{samples.SUMMARY}', '[*][*]：([0-9]+)', 1)) x)), n as (select count(*) counted from ({TABLE_SQL}))
select stated, counted, stated = counted agrees from s, n""")
def c8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.check_totals(reader.parse_summary(samples.lines(spark, samples.SUMMARY)), c1(spark, sf_dir))


@query("k1_directory_tree", "select 'lang=' || lang category, 'source=' || source topic, cast(sum(length(text) + 1) as bigint) chars from documents group by all")
def k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as a tree of text files, a folder for each language and source, and read by category and topic."""
    folder = work_folder(spark, "tree")
    table(spark, sf_dir, "documents").select("lang", "source", "text").write.partitionBy("lang", "source").text(folder)
    return reader.read_tree(spark, folder).groupBy("category", "topic").agg(F.sum(F.length("value")).alias("chars"))


@query(
    "k2_html_to_text",
    r"""select page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) as text from pages""",
)
def k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query("k3_normalise", r"select doc_id, md5(trim(regexp_replace(lower(text), '[ \t\r\n]+', ' ', 'g'))) digest from documents")
def k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalise(F.col("text"))).alias("digest"))


@query(
    "k4_chunks",
    "select doc_id, cast(k as int) chunk, cast(k * 800 as int) as start, substr(text, k * 800 + 1, 1000) as text from (select doc_id, text, unnest(range(greatest(length(text) - 201, 0) // 800 + 1)) k from documents)",
)
def k4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.chunks(table(spark, sf_dir, "documents"))


@query("k5_exact_copies", "select md5(text) digest, min(doc_id) keeper, count(*) copies from documents group by text")
def k5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.exact_copies(table(spark, sf_dir, "documents"))


@query("k7_quality_gate", "select doc_id, lang, source, n_chars from documents join labels using (doc_id) where quality = 1 and toxic = 0")
def k7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.quality_gate(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), table(spark, sf_dir, "labels"))


@query("k9_repeated_lines", "select doc_id, cast(len(string_split(text, chr(10))) as bigint) as lines, round(1 - len(list_distinct(string_split(text, chr(10)))) / len(string_split(text, chr(10))), 6) ratio from documents")
def k9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.repeated_line_ratio(table(spark, sf_dir, "documents"))


@query("k10_composition", "select lang, source, cast(grouping(lang) * 2 + grouping(source) as bigint) as level, count(*) docs, cast(sum(length(text)) as bigint) chars from documents group by rollup (lang, source)")
def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.composition(table(spark, sf_dir, "documents"), "lang", "source")


_INDEXES: dict[tuple, postings.Postings] = {}


def _index(spark: SparkSession, sf_dir: str) -> postings.Postings:
    """The index of the documents, built once a session for the same files; the queries on it read no text."""
    docs = table(spark, sf_dir, "documents")
    key = (spark.sparkContext.applicationId, hash(tuple(sorted(docs.inputFiles()))))
    if key not in _INDEXES:
        _INDEXES[key] = postings.build_postings(docs, work_folder(spark, "postings"), buckets=16)
    return _INDEXES[key]


@query("r1_inverted_index", f"select term, count(distinct doc_id) df, count(*) tf from (select doc_id, unnest({WORDS}) term from documents) group by term")
def r1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).terms()


@query("r1_postings", f"select term, doc_id, cast(count(*) as int) tf from (select doc_id, unnest({WORDS}) term from documents) group by term, doc_id")
def r1_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).postings().select("term", F.inline("docs")).select("term", "doc_id", "tf")


#: Letters as Han characters of one block. Fixed values.
LATIN, HAN = "abcdefghijklmnopqrst", "一二三四五六七八九十百千万上下左右大小中"
HAN_TEXT = f"translate(lower(text), '{LATIN}', '{HAN}')"


@query(
    "r1_han_terms",
    f"""with r as (select doc_id, unnest(regexp_extract_all({HAN_TEXT}, '[\\x{{4E00}}-\\x{{9FFF}}]+|(?:[^\\P{{L}}\\x{{4E00}}-\\x{{9FFF}}]|\\p{{N}})+')) run from documents where lang = 'en'),
t as (select doc_id, unnest(case when regexp_matches(run, '^[\\x{{4E00}}-\\x{{9FFF}}]') and length(run) > 1 then list_transform(range(1, length(run)), lambda k: substr(run, k, 2)) else [run] end) term from r)
select term, count(distinct doc_id) df, count(*) tf from t group by term""",
)
def r1_han(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given texts are in Latin letters, so most of the letters of the English ones are replaced by Han characters."""
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id", F.translate(F.lower("text"), LATIN, HAN).alias("text"))
    return postings.build_postings(docs, work_folder(spark, "han"), tokenise=T.mixed_tokens, buckets=16).terms()


def bm25_sql(*terms: str) -> str:
    values = ", ".join(f"('{t}')" for t in terms)
    return f"""with w as (select doc_id, {WORDS} words from documents), s as (select count(*) n, avg(len(words)) mean from w),
tf as (select doc_id, len(words) dl, term, len(list_filter(words, lambda x: x = term)) tf from w, (values {values}) t(term)),
hit as (select * from tf where tf > 0), df as (select term, count(*) df from hit group by term),
scores as (select doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) score from hit join df using (term), s group by doc_id)
"""


ASKED, ASKED_NEXT = ["the", "and", "ein"], ["of", "in", "der"]
BM25_SQL = bm25_sql(*ASKED)


@query("r2_bm25", BM25_SQL + "select doc_id, score from scores")
def r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).bm25(ASKED)


@query(
    "r2_best_of_gated",
    BM25_SQL + "select doc_id, score, row_number() over (order by score desc, doc_id) as rank from scores join labels using (doc_id) where quality = 1 and toxic = 0 order by score desc, doc_id limit 10",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question answered: the ten best of the good, harmless documents. A limit is what the report is."""
    return retrieval.top_k(corpus.quality_gate(_index(spark, sf_dir).bm25(ASKED), table(spark, sf_dir, "labels")), 10)


@query("r2_block_max", BM25_SQL + "select doc_id, score from scores order by score desc, doc_id limit 10")
def r2_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best by block maxima: blocks that cannot hold one of them are not opened. A limit is what the report is."""
    return _index(spark, sf_dir).best(ASKED, 10)


@query(
    "r3_cosine_top_k",
    """with e as (select vec_id, cast(embedding as double[]) v from embeddings),
s as (select q.vec_id query_id, e.vec_id, round(list_cosine_similarity(q.v, e.v), 6) cosine from e q, e where q.vec_id % 20 = 0 and q.vec_id <> e.vec_id)
select query_id, vec_id, cosine, row_number() over (partition by query_id order by cosine desc, vec_id) as rank from s qualify rank <= 10""",
)
def r3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return retrieval.cosine_top_k(vectors, vectors.filter("vec_id % 20 = 0"))


@query(
    "r4_rank_fusion",
    f"""with a as ({bm25_sql(*ASKED)}select doc_id, row_number() over (order by score desc, doc_id) as rank from scores),
b as ({bm25_sql(*ASKED_NEXT)}select doc_id, row_number() over (order by score desc, doc_id) as rank from scores)
select doc_id, round(sum(1 / (60 + rank)), 9) score from (select * from a union all select * from b) group by doc_id""",
)
def r4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexical rankings of two questions fused."""
    index = _index(spark, sf_dir)
    return retrieval.fuse_ranks(*[retrieval.ranked(index.bm25(terms), "score") for terms in (ASKED, ASKED_NEXT)])


VECTORS_SQL = f"""with t as materialized (select doc_id, term, count(*) tf from (select doc_id, unnest({WORDS}) term from documents) group by all),
i as (select term, ln(1 + ((select count(*) from documents) - count(*) + 0.5) / (count(*) + 0.5)) idf, cast('0x' || substr(md5(term), 1, 6) as bigint) % 256 dim, case when substr(md5(term), 7, 1) < '8' then 1 else -1 end sign from t group by term),
x as (select doc_id, dim, sum(sign * tf * idf) x from t join i using (term) group by all), norms as (select doc_id, sqrt(sum(x * x)) norm from x group by doc_id),
q as (select dim, sum(sign * idf) y from i where term in ({", ".join(f"'{t}'" for t in ASKED)}) group by dim),
cosines as (select doc_id, round(sum(x * y) / any_value(norm) / (select sqrt(sum(y * y)) from q), 6) score from x join q using (dim) join norms using (doc_id) group by doc_id)
"""


@query("r3_question_cosine", VECTORS_SQL + "select doc_id, score from cosines where score > 0")
def r3_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by the cosine of its hashed tf-idf vector to the question's."""
    index = _index(spark, sf_dir)
    return postings.cosine(index.vectors(), index.question_vector(ASKED))


@query(
    "r4_lexical_and_vector",
    f"""with a as ({BM25_SQL}select doc_id, row_number() over (order by score desc, doc_id) as rank from scores), b as ({VECTORS_SQL}select doc_id, row_number() over (order by score desc, doc_id) as rank from cosines where score > 0)
select doc_id, round(sum(1 / (60 + rank)), 9) score from (select * from a union all select * from b) group by doc_id""",
)
def r4_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexical and the vector ranking of one question fused, both from the index."""
    index = _index(spark, sf_dir)
    lexical, near = index.bm25(ASKED), kept(postings.cosine(index.vectors(), index.question_vector(ASKED)), "near")
    return retrieval.fuse_ranks(retrieval.ranked(lexical, "score"), retrieval.ranked(near, "score"))


@query("r5_filtered_retrieval", BM25_SQL + "select doc_id, score from scores join documents using (doc_id) where lang = 'de'")
def r5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).bm25(ASKED, of=table(spark, sf_dir, "documents").filter("lang = 'de'"))


@query(
    "r6_context_budget",
    "select doc_id, source, n_chars, running from (select doc_id, source, n_chars, cast(sum(n_chars) over (partition by source order by doc_id rows unbounded preceding) as bigint) running from documents) where running <= 20000",
)
def r6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.context_under_budget(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), 20_000, "source", rank="doc_id")


KEYWORDS_SQL = "(values " + ", ".join(f"('{t}', '{w}')" for t, ws in ROUTES.items() for w in ws) + ") k(topic, term)"


@query(
    "t1_keyword_route",
    f"""with h as (select doc_id, topic, cast(sum(len(list_filter({WORDS}, lambda w: w = term))) as bigint) hits from documents, {KEYWORDS_SQL} group by doc_id, topic)
select doc_id, case when max(hits) = 0 then 'unrouted' else arg_min(topic, (-hits, topic)) end route, max(hits) hits from h group by doc_id""",
)
def t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    keywords = spark.createDataFrame([(t, w) for t, ws in ROUTES.items() for w in ws], "topic string, term string")
    return routing.keyword_route(table(spark, sf_dir, "documents"), keywords)


CENTROID_SQL = """with x as (select vec_id, label, unnest(cast(embedding as double[])) x, generate_subscripts(embedding, 1) k from embeddings),
c as (select label, k, avg(x) m from x group by label, k), d as (select vec_id, x.label, c.label route, round(sum(x * m), 6) score from x join c using (k) group by vec_id, x.label, c.label),
r as (select vec_id, label, arg_min(route, (-score, route)) route, max(score) score from d group by vec_id, label)
"""


@query("t2_centroid_route", CENTROID_SQL + "select vec_id, label, route, score from r")
def t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.centroid_route(table(spark, sf_dir, "embeddings"))


@query("t3_confusion", CENTROID_SQL + "select label, " + ", ".join(f"count(*) filter (route = {k}) \"{k}\"" for k in range(10)) + " from r group by label")
def t3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.confusion(t2(spark, sf_dir), routes=list(range(10)))


@query("d1_threads", "select conv_id, count(*) turns, string_agg(role || ': ' || text, chr(10) order by turn) thread from conversations group by conv_id")
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.threads(table(spark, sf_dir, "conversations"))


@query("d2_recent_context", "select conv_id, turn, count(*) over w context_turns, cast(sum(length(text)) over w as bigint) context_chars from conversations window w as (partition by conv_id order by turn rows 2 preceding)")
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.recent_context(table(spark, sf_dir, "conversations"))


@query("d3_previous_speaker", "select conv_id, turn, role, lag(role) over (partition by conv_id order by turn) previous_role from conversations")
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.previous_speaker(table(spark, sf_dir, "conversations"))


@query("s1_redaction", f"select doc_id, regexp_replace(regexp_replace(text, '{T.EMAIL}', '[EMAIL]', 'g'), '{T.PHONE}', '[PHONE]', 'g') as text from documents")
def s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.redact(F.col("text")).alias("text"))


@query("s2_toxicity_gate", "select doc_id, lang from documents where doc_id not in (select doc_id from labels where toxic = 1)")
def s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.toxicity_gate(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"))


@query("s3_review_sample", "select doc_id, source from documents where cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) % 10 = 0")
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: a tenth of the documents, the same on any engine."""
    return table(spark, sf_dir, "documents").select("doc_id", "source").filter(T.sample_bucket(F.col("doc_id"), 10) == 0)


@query("u1_daily_activity", "select cast(ts as date) as day, event_type, count(*) events, count(distinct user_id) users from events group by all")
def u1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.daily_activity(table(spark, sf_dir, "events"))


@query(
    "u2_sessions",
    """with m as (select user_id, ts, case when ts - lag(ts) over w <= interval 30 minutes then 0 else 1 end opens from events window w as (partition by user_id order by ts)),
s as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) k from m) select user_id, min(ts) session_start, max(ts) last_event, count(*) events from s group by user_id, k""",
)
def u2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.sessions(table(spark, sf_dir, "events"))


@query(
    "u3_funnel",
    """with a as (select user_id, min(ts) began from events where event_type = 'view' group by user_id), b as (select user_id, max(ts) ended from events where event_type = 'purchase' group by user_id)
select count(*) users_first, count(*) filter (ended > began) users_then from a left join b using (user_id)""",
)
def u3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.funnel(table(spark, sf_dir, "events"), "view", "purchase")


@query("u4_json_property", "select event_type, count(try_cast(props->>'$.k' as bigint)) events, cast(sum(try_cast(props->>'$.k' as bigint)) as bigint) total from events group by event_type")
def u4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.property_totals(table(spark, sf_dir, "events"))


@query(
    "u5_trailing_week",
    "select event_id, user_id, ts, count(*) over w n, round(sum(value) over w, 2) total from events window w as (partition by user_id order by ts range between interval 7 days preceding and current row)",
)
def u5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user did in the week up to each event, by a frame of time."""
    week = temporal.trailing_counts(table(spark, sf_dir, "events"), "user_id", "ts", 7 * 86_400, "value", "event_id")
    return week.select("event_id", "user_id", "ts", "n", F.round("total", 2).alias("total"))


@query("u6_weekly_distinct", "select cast(date_trunc('week', ts) as date) as week, event_type, count(distinct user_id) users, true as within_bound from events group by all")
def u6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users a week by merging the sketches of days, and whether that is within 5 % of the exact count."""
    events = table(spark, sf_dir, "events")
    days = usage.distinct_sketches(events, F.to_date("ts"), "event_type")
    weeks = usage.merged_distinct(days, F.trunc("by", "week"), "event_type").withColumnRenamed("by", "week")
    exact = events.groupBy(F.trunc(F.to_date("ts"), "week").alias("week"), "event_type").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1), 0.05 * F.col("users"))
    return exact.join(weeks, ["week", "event_type"], "left").select("week", "event_type", "users", F.coalesce(near, F.lit(False)).alias("within_bound"))


@query(
    "j1_as_of",
    """with p as (select event_id, user_id, ts from events where event_type = 'purchase'), v as (select event_id last_event_id, user_id, ts last_ts, value last_value from events where event_type = 'view')
select p.*, last_ts, last_event_id, last_value from p left join v on p.user_id = v.user_id and last_ts <= ts qualify row_number() over (partition by event_id order by last_ts desc, last_event_id desc) = 1""",
)
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's latest view before it."""
    events = table(spark, sf_dir, "events")
    bought, seen = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), events.filter("event_type = 'view'")
    return temporal.as_of_join(bought, seen, "user_id", "ts", "event_id", ["event_id", "value"])


@query(
    "j2_interval",
    """with m as (select user_id, ts, case when ts - lag(ts) over w <= interval 30 minutes then 0 else 1 end opens from events window w as (partition by user_id order by ts)),
k as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) k from m), s as (select user_id other, min(ts) a, max(ts) + interval 30 minutes b from k group by user_id, k)
select event_id, count(*) sessions, min(a) earliest from events join s on ts between a and b and user_id <> other where event_type = 'error' group by event_id""",
)
def j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each error, how many sessions of other users were open, half an hour past their last event included."""
    events = table(spark, sf_dir, "events")
    spans = usage.sessions(events).select(F.col("user_id").alias("other"), F.col("session_start").alias("a"), (F.col("last_event") + F.expr("interval 30 minutes")).alias("b"))
    errors = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    pairs = temporal.interval_join(errors, spans, "ts", "a", "b", bin_seconds=3600, on=F.col("user_id") != F.col("other"))
    return pairs.groupBy("event_id").agg(F.count("*").alias("sessions"), F.min("a").alias("earliest"))


@query("st1_stream_dedup", "select distinct event_id, user_id, event_type from events")
def st1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event comes twice, as from a source that delivers at least once."""
    twice = streams.event_stream(spark, sf_dir).unionByName(streams.event_stream(spark, sf_dir))
    stream = streams.without_repeats(twice, "40 days").select("event_id", "user_id", "event_type")
    return streams.run_to_files(spark, stream, "st1")


@query("st2_stream_windows", "select date_trunc('day', ts)::date as day, event_type, count(*) events from events where date_trunc('day', ts) + interval 1 day <= (select max(ts) from events) - interval 1 hour group by all")
def st2(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = streams.windowed_counts(streams.event_stream(spark, sf_dir)).select(F.to_date("start").alias("day"), "event_type", "events")
    return streams.run_to_files(spark, counts, "st2")


@query("st3_stream_upsert", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def st3(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.event_stream(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    return streams.upsert_latest(spark, stream, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@query("st4_stream_funnel", SQL["u3_funnel"])
def st4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel of u3 from keyed state, over three deliveries with a restart after each."""
    events = _timed(spark, sf_dir).select("user_id", "event_type", "ts")
    rows = streams.run_in_steps(spark, streams.in_steps(events, "ts", 3), lambda stream: stateful.funnel_stream(stream, "view", "purchase"), "st4", **ROCKS)
    return stateful.funnel_totals(rows)


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


#: Deliveries by equal parts of time; every 50th event comes one delivery late, and a day behind the latest event is the watermark.
DELIVERED_SQL = """with e as (select *, epoch_us(ts) us from events), b as (select min(us) low, max(us) - min(us) + 1 width from e),
d as (select e.*, (us - low) // ((width + 3) // 4) + case when event_id % 50 = 0 then 1 else 0 end as delivery from e, b),
m as (select k.delivery, max(us) // 1000 - 86400000 as mark from d, (select distinct delivery from d) k where d.delivery < k.delivery group by k.delivery),
last as (select max(us) // 1000 - 86400000 as mark from d),
"""


def _late_sql(slide_hours: int) -> str:
    return f"""{DELIVERED_SQL}w as (select d.*, time_bucket(interval {slide_hours} hours, ts, timestamp '1970-01-01') - to_hours(cast(k * {slide_hours} as bigint)) as start from d, range({24 // slide_hours}) r(k)),
c as (select start, count(*) filter (coalesce(epoch_ms(start) + 86400000 > m.mark, true)) events, count(*) n from w left join m using (delivery) group by start)
select start, events, n - events as late from c, last where epoch_ms(start) + 86400000 <= mark and events > 0"""


@query("st5_late_tumbling", _late_sql(24))
def st5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events a day where some are delivered late, and how many came after their day was closed."""
    return _late(spark, sf_dir, "1 day", None)


@query("st5_late_sliding", _late_sql(6))
def st5_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by days that begin every six hours."""
    return _late(spark, sf_dir, "1 day", "6 hours")


def _late(spark: SparkSession, sf_dir: str, width: str, slide: str | None) -> DataFrame:
    events = _timed(spark, sf_dir).select("event_id", "ts")
    steps = streams.in_steps(events, "ts", 4, F.col("event_id") % 50 == 0)
    counted = streams.run_in_steps(spark, steps, lambda stream: streams.window_counts(stream, width, slide), "st5")
    return streams.with_late(counted, events, width, slide).select(F.col("start").cast("timestamp_ntz"), "events", "late")


@query(
    "st6_stream_sessions",
    """with m as (select user_id, ts, case when ts - lag(ts) over w <= interval 30 minutes then 0 else 1 end opens from events window w as (partition by user_id order by ts)),
s as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) k from m)
select user_id, min(ts) session_start, max(ts) + interval 30 minutes session_end, count(*) events from s group by user_id, k having epoch_us(max(ts)) + 1800000000 <= (select (max(epoch_us(ts)) // 1000 - 3600000) * 1000 from events)""",
)
def st6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' sessions that a stream has closed, over three deliveries; sessions go on from one to the next."""
    steps = streams.in_steps(_timed(spark, sf_dir).select("user_id", "ts"), "ts", 3)
    closed = streams.run_in_steps(spark, steps, streams.session_counts, "st6")
    return closed.select("user_id", F.col("session_start").cast("timestamp_ntz"), F.col("session_end").cast("timestamp_ntz"), "events")


EVENT = "event_id long, user_id long, event_type string, value double"


@query(
    "src1_json_bad_rows",
    """select cast(ts as date) as day, count(*) filter (event_id % 97 <> 0 and event_id % 101 <> 0) good, count(*) filter (event_id % 97 = 0 or event_id % 101 = 0) bad,
sum(user_id) filter (event_id % 97 <> 0 and event_id % 101 <> 0)::bigint users, count(distinct event_type) filter (event_id % 97 <> 0 and event_id % 101 <> 0) kinds from events group by 1""",
)
def src1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines in a folder a day, some with text for a number and some cut off, read by a declared schema."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    value = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    wrong = F.to_json(F.struct("event_id", "user_id", "event_type", value.alias("value")))
    line = F.when(F.col("event_id") % 101 == 0, F.left(line, F.lit(20))).when(F.col("event_id") % 97 == 0, wrong).otherwise(line)
    folder = typed.write_partitioned(events.select(line.alias("line"), "day"), "text", "src1", "day")
    rows = typed.read_typed(spark, folder, "json", EVENT, "day date")
    good = typed.fitting(rows).groupBy("day").agg(F.count("*").alias("good"), F.sum("user_id").alias("users"), F.count_distinct("event_type").alias("kinds"))
    bad = typed.misfits(rows, "day").groupBy("day").agg(F.count("*").alias("bad"))
    return good.join(bad, "day", "full").select("day", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"), "users", F.coalesce("kinds", F.lit(0)).alias("kinds"))


@query(
    "src2_csv_pruned",
    "select cast(ts as date) as day, event_type, count(*) events, max(value) most from events where event_id % 97 <> 0 and ts >= (select max(ts)::date - 6 from events) group by 1, 2",
)
def src2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of events as CSV in a folder a day, some with text for a number: the last seven days, from their folders alone."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    value = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    folder = typed.write_partitioned(events.select("event_id", "user_id", "event_type", value.alias("value"), "day"), "csv", "src2", "day", header="true")
    last = events.agg(F.max("day")).first()[0]
    rows = typed.read_typed(spark, folder, "csv", EVENT, "day date", header="true").filter(F.col("day") >= F.date_sub(F.lit(last), 6))
    return typed.fitting(rows).groupBy("day", "event_type").agg(F.count("*").alias("events"), F.max("value").alias("most"))
