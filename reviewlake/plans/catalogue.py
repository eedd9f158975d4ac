"""The registered queries of the relational, text, vector and cluster operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.config import EUROPEAN, KOREAN, POLARITIES, LanguagePack, Settings
from reviewlake.functions import labels as L
from reviewlake.functions import text as T
from reviewlake.functions import vectors as V
from reviewlake.operators import clusters as C
from reviewlake.operators import density, keywords, polarity, preprocess, relevance, report
from reviewlake.plans import reviews as plans
from reviewlake.session import checkpointed, spread, table
from reviewlake.sources import reviews as S

#: The made-up texts of the tables hold function words alone, so these stand in for words of praise and blame.
MADE_UP = replace(EUROPEAN, positive=("the", "der", "le", "los"), negative=("not", "nicht", "pas", "no"))
SETTINGS = Settings(language=MADE_UP)
KO = Settings()
QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ---- parts of SQL that several queries share -------------------------------------------------------------------------


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _clean(x: str) -> str:
    step = rf"regexp_replace({_strip(f'coalesce({x}, {chr(39) * 2})')}, 'ㅋ{{3,}}', 'ㅋㅋ', 'g')"
    step = rf"regexp_replace({step}, '(!|\?){{2,}}', '\1', 'g')"
    return rf"regexp_replace({step}, '[^\p{{L}}\p{{N}}_\s\x{{AC00}}-\x{{D7A3}}.!?]+', '', 'g')"


def _pieces(x: str, breaks: str = r"\n") -> str:
    marked = rf"regexp_replace(regexp_replace(coalesce({x}, ''), '([.!?。…])\s+', '\1' || chr(1), 'g'), '{breaks}', chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {_strip('s')}), lambda s: s <> '')"


def _posts_pieces(x: str) -> str:
    lines = f"list_filter(list_transform(string_split(coalesce({x}, ''), chr(10)), lambda s: {_strip('s')}), lambda s: s <> '')"
    many = _pieces(x, r"\n+")
    return f"case when len({many}) <= 1 and contains(coalesce({x}, ''), chr(10)) then {lines} else {many} end"


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


SENTENCES = f"""sent as (
  select doc_id, source, lang, unnest(range(len(p))) as pos, unnest(p) as sentence from (select *, {_pieces('text')} as p from documents))"""
WORDS = r"string_split_regex(lower(sentence), '[^\p{L}\p{N}]+')"
POLARITY = f"""{SENTENCES}, counted as (
  select *, len(list_filter({WORDS}, lambda w: w in ({_in(MADE_UP.positive)}))) as p, len(list_filter({WORDS}, lambda w: w in ({_in(MADE_UP.negative)}))) as n from sent),
polar as (
  select doc_id, source, lang, pos, sentence, case when p > n then 'positive' when n > p then 'negative' else 'neutral' end as polarity,
         case when p = n then 1.0::double / (1 + p + n) else (1 + abs(p - n)::double / (1 + p + n)) / 2 end as confidence from counted)"""
DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::double * z[2]::double))"


def _dot(a: str, b: str) -> str:
    return f"list_inner_product({a}::double[], {b}::double[])"


def _cos(a: str, b: str) -> str:
    return f"({_dot(a, b)} / (sqrt({_dot(a, a)}) * sqrt({_dot(b, b)})))"


def _euclid(a: str, b: str) -> str:
    return f"list_distance({a}::double[], {b}::double[])"


GROUPS = """items as (
  select g, list(m order by i) as v from (
    select vec_id % 40 as g, i, avg(x::double) as m from (select vec_id, unnest(range(len(embedding))) as i, unnest(embedding) as x from embeddings) group by 1, 2) group by g)"""
PAIRS = f"{GROUPS}, pairs as (select a.g as cid1, b.g as cid2, {_cos('a.v', 'b.v')} as sim from items a join items b on a.g < b.g)"
NEAR = 0.18


def _docs(spark, d):
    return spread(table(spark, d, "documents"))


def _reviews(spark, d) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("review_id"), F.col("text").alias("review"), F.col("source").alias("platform"), F.col("lang").alias("product"))


def _sentences(spark, d) -> DataFrame:
    return _docs(spark, d).select("doc_id", "source", "lang", F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence"))


def _polar(spark, d) -> DataFrame:
    return polarity.classify(_sentences(spark, d), SETTINGS, "sentence")


def _vectors(spark, d) -> DataFrame:
    return table(spark, d, "embeddings")


def _items(spark, d) -> DataFrame:
    return C.centroids(_vectors(spark, d).withColumn("g", F.col("vec_id") % 40), "g", "embedding").select("g", F.col("centroid").alias("v"))


def _pairs(spark, d) -> DataFrame:
    return C.merge_candidates(_items(spark, d), "g", "v", -2.0)


# ---- sources -----------------------------------------------------------------------------------------------------------


@query("select cast(doc_id as varchar) as review_id, text as review, source as platform, lang as product from documents")
def scan_reviews(spark, d):
    return _reviews(spark, d).drop("doc_id")


@query("select source as platform, lang as product, text as review from documents")
def normalize_columns(spark, d):
    raw = _docs(spark, d).select(F.col("source").alias(" Platfrom "), F.col("lang").alias("Product_Name"), F.col("text").alias("Review_Text"), F.col("doc_id").alias("Unnamed: 0"))
    return S.normalize_columns(raw)


@query("select coalesce(case when doc_id % 3 = 0 then text end, case when doc_id % 2 = 0 then source end) as review, lang as product from documents")
def normalize_duplicate_headers(spark, d):
    raw = _docs(spark, d).select(F.when(F.col("doc_id") % 3 == 0, F.col("text")).alias("Comments"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("content"), F.col("lang").alias("product"))
    return S.normalize_columns(raw)


POSTS = """posts as (
  select 'x' as product, role as platform, 'conv/' || conv_id || '/' || turn as link, cast(null as varchar) as date, 'Turn ' || turn as title, coalesce(text, '') as body,
         case when turn % 3 = 0 then coalesce(text, '') else '' end as summary,
         'C-x-' || substr(md5('conv/' || conv_id || '/' || turn || '|' || 'Turn ' || turn), 1, 10) as post_id
  from conversations)"""


def _posts(spark, d) -> DataFrame:
    link = F.concat(F.lit("conv/"), F.col("conv_id"), F.lit("/"), F.col("turn"))
    raw = table(spark, d, "conversations").select(
        F.col("role").alias("플랫폼"), link.alias("url"), F.concat(F.lit("Turn "), F.col("turn")).alias("제목"), F.col("text").alias("본문"), F.when(F.col("turn") % 3 == 0, F.col("text")).alias("요약")
    )
    return S.load_posts(raw, "x")


@query(f"with {POSTS} select * from posts")
def load_posts(spark, d):
    return _posts(spark, d)


@query(f"with {POSTS} select link, post_id from posts")
def post_id(spark, d):
    return _posts(spark, d).select("link", "post_id")


@query(f"with {POSTS} select post_id, platform, cast(null as bigint) as n_chars from posts union all by name select url as post_id, cast(null as varchar) as platform, cast(length(html) as bigint) as n_chars from pages")
def union_posts(spark, d):
    pages = table(spark, d, "pages").select(F.col("url").alias("post_id"), F.length("html").cast("long").alias("n_chars"))
    return S.union_tables(_posts(spark, d).select("post_id", "platform"), pages)


@query("select 'a' as source_file, doc_id, lang, cast(null as bigint) as n_chars from documents union all select 'b', doc_id, cast(null as varchar), n_chars from documents")
def merge_all(spark, d):
    docs = _docs(spark, d)
    return S.merge_all({"b": docs.select("doc_id", "n_chars"), "a": docs.select("doc_id", "lang")})


@query("select source as product, case when source in ('src1', 'src3') then 'facets_' || source || '.yml' else 'facets.yml' end as path from (select distinct source from documents)")
def resolve_rules(spark, d):
    available = spark.createDataFrame([("src1", "facets_src1.yml"), ("src3", "facets_src3.yml"), (None, "facets.yml")], "product string, path string")
    return S.resolve_rules(_docs(spark, d).select(F.col("source").alias("product")).distinct(), available)


@query("select * from (values ('sweetness', 'Sweet ness', 'sweet taste'), ('price', 'price', 'cheap, dear'), ('size', 'size', 'about size')) t(id, name, \"desc\")")
def facets_dim(spark, d):
    given = {"buckets": [{"id": "Sweet ness", "desc": "sweet taste"}, {"name": "price", "keywords": ["cheap", "dear"]}, {"id": "size"}]}
    return S.facets_table(spark, S.parse_facets(given))


@query("select doc_id, length(text) as n from documents where doc_id is not null")
def resume_cache(spark, d):
    from reviewlake.session import scratch_path
    from reviewlake.sources import sinks

    path = scratch_path(spark, "cache")
    docs = _docs(spark, d).select("doc_id", "text")
    compute = lambda rows: rows.select("cache_key", "doc_id", F.length("text").cast("long").alias("n"))
    sinks.cached(docs.filter("doc_id % 2 = 0"), ["doc_id", "text"], compute, path)
    return sinks.cached(docs, ["doc_id", "text"], compute, path).select("doc_id", "n")


# ---- text --------------------------------------------------------------------------------------------------------------


@query(f"select doc_id, {_clean('text')} as review from documents")
def clean_text(spark, d):
    return _docs(spark, d).select("doc_id", T.clean(F.col("text")).alias("review"))


@query(f"select min(doc_id) as doc_id, review from (select doc_id, {_clean('text')} as review from documents) group by review")
def dedupe_first(spark, d):
    return preprocess.dedupe_first(_docs(spark, d).select("doc_id", T.clean(F.col("text")).alias("review")), "review", "doc_id")


@query(
    f"""select doc_id, review, cast(row_number() over (order by doc_id) - 1 as varchar) as review_id
    from (select min(doc_id) as doc_id, review from (select doc_id, {_clean('text')} as review from documents) group by review) where length(review) > 0"""
)
def preprocess_reviews(spark, d):
    docs = _docs(spark, d).select("doc_id", F.col("text").alias("review"))
    return preprocess.with_review_id(preprocess.preprocess(docs, "doc_id"), "doc_id")


@query(f"with {SENTENCES} select doc_id, pos, sentence from sent")
def split_sentences(spark, d):
    return _sentences(spark, d).select("doc_id", "pos", "sentence")


@query(f"select conv_id, turn, unnest(range(len(p))) as pos, unnest(p) as sentence from (select *, {_posts_pieces('text')} as p from conversations)")
def split_sentences_comm(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(T.community_sentences(F.col("text"))).alias("pos", "sentence"))


def _found(key: str, text: str, src: str, pack: LanguagePack = EUROPEAN) -> str:
    listed = ", ".join(f"({n}, '{k}', '{w}')" for n, (k, w) in enumerate((k, w) for k, own in pack.connectives.items() for w in own))
    return f"""words(n, kind, word) as (values {listed}),
cut as (select {key}, {text} as t, n, kind, word, string_split({text}, word) as p from {src}, words where contains({text}, word)),
hits as (select {key}, t, n, kind, word, cast(list_sum(list_transform(p[1:k], lambda x: length(x))) + (k - 1) * length(word) as int) as idx from (select *, unnest(range(1, len(p))) as k from cut))"""


@query(f"with {_found('doc_id', 'text', 'documents')} select doc_id, idx, kind, word from hits")
def connective_scan(spark, d):
    return _docs(spark, d).select("doc_id", F.explode(T.connectives(F.col("text"), EUROPEAN)).alias("x")).select("doc_id", "x.idx", "x.kind", "x.word")


def _tokens(x: str, pattern: str = EUROPEAN.token) -> str:
    return f"list_distinct(regexp_extract_all({x}, '{pattern}'))"


def _jaccard_sql(a: str, b: str) -> str:
    return f"case when len({a}) + len({b}) = 0 then 1.0::double else len(list_intersect({a}, {b}))::double / greatest(1, len({a}) + len({b}) - len(list_intersect({a}, {b}))) end"


@query(
    f"""with {SENTENCES}, toks as (select doc_id, pos, {_tokens('sentence')} as a, lead({_tokens('sentence')}) over (partition by doc_id order by pos) as b from sent)
    select doc_id, pos, round({_jaccard_sql('a', 'b')}, 6) as j from toks where b is not null"""
)
def jaccard(spark, d):
    tok = _sentences(spark, d).select("doc_id", "pos", F.array_distinct(T.tokens(F.col("sentence"), "[A-Za-z]{2,}")).alias("a"))
    pairs = tok.withColumn("b", F.lead("a").over(W.partitionBy("doc_id").orderBy("pos"))).filter("b is not null")
    return pairs.select("doc_id", "pos", F.round(T.jaccard(F.col("a"), F.col("b")), 6).alias("j"))


def _piece(a: str, b: str | None) -> str:
    cut = f"s[{a} + 1 : {b}]" if b else f"s[{a} + 1 :]"
    return _strip(cut)


def _folded(pack: LanguagePack) -> str:
    """keyed(key, sentence) to parted(key, p), p the clauses of a sentence; with an enumeration where nothing connects."""
    left, right = _strip("sentence[acc.l + 1 : x.l]"), _strip("sentence[x.l + 1 :]")
    guard = "" if pack.enumeration is None else f""",
    guarded as (select key, strpos(sentence, regexp_extract(sentence, '{pack.enumeration}')) - 1 + length(regexp_extract(sentence, '{pack.enumeration}')) as idx from keyed
      where key not in (select key from hits) and regexp_matches(sentence, '{pack.enumeration}'))"""
    more = "" if pack.enumeration is None else " union all select key, [{'l': idx::int, 'u': 0, 'parts': ['additive']}] from guarded"
    return f"""{_found('key', 'sentence', 'keyed', pack)}{guard},
    cands as (select key, list({{'l': idx, 'u': 0, 'parts': [kind]}} order by idx, n) as c from hits group by key{more}),
    folded as (select e.key, sentence as s, list_reduce(coalesce(c, []), lambda acc, x:
      case when acc.u < 3 and x.l > acc.l + 1 and length({left}) >= 4 and length({right}) >= 4 and x.parts[1] <> 'conditional'
        and {_jaccard_sql(_tokens(left, pack.token), _tokens(right, pack.token))} <= case when x.parts[1] = 'contrast' then 0.40 else 0.35 end
      then {{'l': x.l, 'u': acc.u + 1, 'parts': list_append(acc.parts, {left})}} else acc end,
      {{'l': 0, 'u': 0, 'parts': []::varchar[]}}) as f from keyed e left join cands using (key)),
    parted as (select key, list_filter(list_append(f.parts, {_strip('s[f.l + 1 :]')}), lambda p: p <> '') as p from folded)"""


@query(
    f"""with {SENTENCES}, keyed as (select doc_id * 100000 + pos as key, sentence from sent), {_folded(EUROPEAN)},
    flat as (select key // 100000 as doc_id, key % 100000 as pos, unnest(range(len(p))) as i, unnest(p) as clause from parted)
    select doc_id, row_number() over (partition by doc_id order by pos, i) - 1 as clause_idx, clause from flat"""
)
def split_clauses(spark, d):
    return plans.clause_rows(_docs(spark, d), SETTINGS, "text", "doc_id")


@query("select doc_id, len(list_filter(['the', 'haus', 'que', ''], lambda t: t <> '' and contains(text, t))) > 0 as hit from documents")
def contains_any(spark, d):
    return _docs(spark, d).select("doc_id", T.contains_any(F.col("text"), ["the", "haus", "que", ""]).alias("hit"))


BONUS = "least(0.1::double * len(list_filter(['thing', 'que', 'und', 'thing', 'der', 'los'], lambda t: contains({x}, t))), 0.3::double)"
BONUS_TERMS = ["thing", "que", "und", "thing", "der", "los", ""]


@query(f"select doc_id, round({BONUS.format(x='text')}, 6) as bonus from documents")
def lexical_bonus(spark, d):
    return _docs(spark, d).select("doc_id", F.round(T.lexical_bonus(F.col("text"), BONUS_TERMS), 6).alias("bonus"))


@query("select x as term, row_number() over (order by f) as n from (select x, min(i) as f from (select unnest(string_split(text, ' ')) as x, item_id * 100000 + unnest(range(len(string_split(text, ' ')))) as i from benchmark) where x <> '' group by x) qualify n <= 64")
def build_queries(spark, d):
    words = table(spark, d, "benchmark").select(F.posexplode(F.split("text", " ")).alias("i", "x"), "item_id")
    return relevance.query_terms(words, "x", ("item_id", "i"), 64)


@query("select item_id, array_to_string(list_filter(string_split(text, ' '), lambda t: t <> '')[1:3], ' ') as head from benchmark")
def query_cap(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.array_join(F.slice(F.filter(F.split("text", " "), lambda t: t != ""), 1, 3), " ").alias("head"))


# ---- Korean texts, as literals --------------------------------------------------------------------------------------------

KOREAN_TEXTS = (
    "맛은 정말 좋아요 하지만 배송이 느려요", "별로예요 실망했어요 썩었네요", "정말 맛있어요 신선하고 좋습니다", "맛도 좋고 향도 아주 좋아요", "비가 온다면 집에서 쉬겠어요", "그리고 하지만 그리고",
    "가격은 비싸요 그러나 품질이 좋아서 만족합니다 그리고 포장도 깔끔했어요. 다음에도 살게요!!", "ㅋㅋㅋㅋ 최고예요!!! 추천합니다^^", "아삭한 사과 맛 하지만 배송이 느려요", "상했어요 ㅠㅠ 최악\n다시는 안 사요", "포장 상태 보통", "",
)
KO_TABLE = "ko as (select * from (values " + ", ".join(f"({i}, replace('{t}', '{chr(92)}n', chr(10)))" for i, t in enumerate(x.replace("\n", chr(92) + "n") for x in KOREAN_TEXTS)) + ") t(id, text))"
KO_WORDS = r"string_split_regex(lower(text), '[^\p{L}\p{N}]+')"
KO_COUNT = "len(list_filter({w}, lambda w: regexp_matches(w, '^({own})')))"


def _korean(spark) -> DataFrame:
    return spark.createDataFrame(list(enumerate(KOREAN_TEXTS)), "id long, text string")


@query(f"with {KO_TABLE} select id, {_clean('text')} as review from ko")
def clean_korean(spark, d):
    return _korean(spark).select("id", T.clean(F.col("text")).alias("review"))


@query(
    f"""with {KO_TABLE}, c as (select id, {KO_COUNT.format(w=KO_WORDS, own='|'.join(KOREAN.positive))} as p, {KO_COUNT.format(w=KO_WORDS, own='|'.join(KOREAN.negative))} as n from ko)
    select id, case when p > n then 'positive' when n > p then 'negative' else 'neutral' end as polarity,
      round(case when p = n then 1.0::double / (1 + p + n) else (1 + abs(p - n)::double / (1 + p + n)) / 2 end, 6) as confidence from c"""
)
def absa_korean(spark, d):
    return polarity.classify(_korean(spark), KO, "text").select("id", "polarity", F.round("confidence", 6).alias("confidence"))


@query(f"with {KO_TABLE}, {_found('id', 'text', 'ko', KOREAN)} select id, idx, kind, word from hits")
def connectives_korean(spark, d):
    return _korean(spark).select("id", F.explode(T.connectives(F.col("text"), KOREAN)).alias("x")).select("id", "x.idx", "x.kind", "x.word")


@query(f"with {KO_TABLE}, keyed as (select id as key, text as sentence from ko), {_folded(KOREAN)} select key as id, unnest(range(len(p))) as pos, unnest(p) as clause from parted")
def clauses_korean(spark, d):
    return _korean(spark).select("id", F.posexplode(T.clauses(F.col("text"), KO)).alias("pos", "clause"))


@query(f"with {KO_TABLE} select a.id, round({_jaccard_sql(_tokens('a.text', KOREAN.token), _tokens('b.text', KOREAN.token))}, 6) as j from ko a join ko b on b.id = a.id + 1")
def jaccard_korean(spark, d):
    tok = _korean(spark).select("id", F.array_distinct(T.tokens(F.col("text"), KOREAN.token)).alias("a"))
    return tok.join(tok.select((F.col("id") - 1).alias("id"), F.col("a").alias("b")), "id").select("id", F.round(T.jaccard(F.col("a"), F.col("b")), 6).alias("j"))


@query(
    f"""with {KO_TABLE}, tok as (select id % 3 as c, id, t as term, count(*) as tf from (select *, unnest(regexp_extract_all(lower(text), '{KOREAN.keyword}')) as t from ko) where t not in ({_in(KOREAN.stopwords)}) group by all),
    idf as (select term, ln((1.0::double + (select count(*) from ko)) / (1.0::double + count(*))) + 1 as idf from tok group by term), w as (select c, id, term, tf * idf as w from tok join idf using (term)),
    len as (select id, sqrt(sum(w * w)) as l from w group by id),
    sc as (select w.c, term, sum(w / l) / any_value(nd) as score from w join len using (id) join (select id % 3 as c, count(*) as nd from ko group by 1) n on n.c = w.c group by w.c, term)
    select c, row_number() over (partition by c order by round(score, 9) desc, term desc) as rank, term, round(score, 6) as score from sc qualify rank <= 3"""
)
def keywords_korean(spark, d):
    rows = _korean(spark).withColumn("c", F.col("id") % 3)
    return keywords.tfidf_keywords(rows, "c", "id", "text", KOREAN.keyword, KOREAN.stopwords).select("c", "rank", "term", F.round("score", 6).alias("score"))


@query(f"with {KO_TABLE}, t as (select id, text, regexp_extract_all(text, '[가-힣]+') as w from ko) select id, word, regexp_full_match(word, '{KOREAN.keyword}') as whole from (select id, unnest(list_distinct(w)) as word from t)")
def keyword_full_match(spark, d):
    words = _korean(spark).select("id", F.explode(F.array_distinct(T.tokens(F.col("text"), "[가-힣]+"))).alias("word"))
    return words.select("id", "word", T.full_match(F.col("word"), KOREAN.keyword).alias("whole"))


# ---- polarity ----------------------------------------------------------------------------------------------------------


@query(f"with {POLARITY} select doc_id, pos, polarity, round(confidence, 6) as confidence from polar")
def absa_lexicon(spark, d):
    return _polar(spark, d).select("doc_id", "pos", "polarity", F.round("confidence", 6).alias("confidence"))


@query(f"with {POLARITY} select polarity, count(*) as n from polar group by polarity")
def polarity_counts(spark, d):
    return _polar(spark, d).groupBy("polarity").agg(F.count("*").alias("n"))


@query(f"with {POLARITY} select doc_id, pos, polarity from polar where confidence >= 0.6")
def polarity_filter(spark, d):
    return polarity.confident(_polar(spark, d), SETTINGS).select("doc_id", "pos", "polarity")


@query(f"with {POLARITY} select doc_id, pos, polarity from polar where confidence >= 0.6 and polarity in ('negative', 'neutral', 'positive')")
def polarity_union(spark, d):
    """The union of the polarities' rows by one filter: a table of each would read and classify all texts anew."""
    return polarity.confident(_polar(spark, d), SETTINGS).filter(F.col("polarity").isin(*POLARITIES)).select("doc_id", "pos", "polarity")


# ---- report ------------------------------------------------------------------------------------------------------------


@query(f"with {SENTENCES} select cast(s.doc_id as varchar) as review_id, pos, d.source as platform, d.lang as product, length(d.text) as n from sent s left join documents d using (doc_id)")
def meta_join(spark, d):
    rows = _sentences(spark, d).select(F.col("doc_id").alias("review_id"), "pos")
    return report.meta_join(rows, _reviews(spark, d)).select("review_id", "pos", "platform", "product", F.length("review").cast("long").alias("n"))


@query("select g as review_id, string_agg(label, ',' order by f) as labels from (select vec_id % 50 as g, label, min(vec_id) as f from embeddings group by all) group by g")
def mapping(spark, d):
    rows = _vectors(spark, d).select((F.col("vec_id") % 50).alias("review_id"), "vec_id", "label")
    return report.mapping(rows, "vec_id", {"label": "l"}).select("review_id", F.array_join(F.transform("l", lambda x: x.cast("string")), ",").alias("labels"))


@query(
    """select doc_id, source as platform, lang as product_name, text as comments, coalesce(m.labels, '') as cluster from documents left join
    (select g, string_agg(label, ',' order by f) as labels from (select vec_id // 3 as g, label, min(vec_id) as f from embeddings group by all) group by g) m on doc_id = g"""
)
def reviews_sheet(spark, d):
    mapped = report.mapping(_vectors(spark, d).select(F.floor(F.col("vec_id") / 3).alias("doc_id"), "vec_id", "label"), "vec_id", {"label": "l"}, key="doc_id")
    return report.reviews_sheet(_reviews(spark, d).drop("review_id"), mapped, {"l": "cluster"}, key="doc_id")


@query("select vec_id as review_id, label as cluster_label, len(embedding) as extra from embeddings")
def clauses_sheet(spark, d):
    rows = _vectors(spark, d).select(F.size("embedding").cast("long").alias("extra"), F.col("label").alias("cluster_label"), F.col("vec_id").alias("review_id"))
    return report.clauses_sheet(rows, ("review_id", "clause", "cluster_label"))


@query(
    f"""with {POLARITY}, r as (select nullif(source, 'src3') as platform from documents), c as (select nullif(source, 'src3') as platform, polarity from polar),
    col as (select coalesce(platform, 'unknown') as platform, count(*) as collected from r group by 1),
    ana as (select coalesce(platform, 'unknown') as platform, count(*) as analysed, count(platform) as n, count(*) filter (platform is not null and polarity = 'positive') as p,
      count(*) filter (platform is not null and polarity = 'neutral') as u, count(*) filter (platform is not null and polarity = 'negative') as g from c group by 1),
    rows as (select coalesce(col.platform, ana.platform) as platform, coalesce(collected, 0) as collected, coalesce(analysed, 0) as analysed, coalesce(n, 0) as n, coalesce(p, 0) as p, coalesce(u, 0) as u, coalesce(g, 0) as g
      from col full join ana on col.platform = ana.platform
      union all select '전체', (select count(*) from r), count(*), count(*), count(*) filter (polarity = 'positive'), count(*) filter (polarity = 'neutral'), count(*) filter (polarity = 'negative') from c)
    select platform, collected, analysed, round_even(case when n > 0 then p / n else 0 end * 100, 1) as positive, round_even(case when n > 0 then u / n else 0 end * 100, 1) as neutral,
      round_even(case when n > 0 then g / n else 0 end * 100, 1) as negative from rows"""
)
def platform_block(spark, d):
    null_one = F.nullif("source", F.lit("src3")).alias("platform")
    return report.platform_block(_docs(spark, d).select(null_one), _polar(spark, d).select(null_one, "polarity"))


@query(
    f"""with {POLARITY} select source as platform, round(count(*) filter (polarity = 'negative') / count(*), 6) as negative, round(count(*) filter (polarity = 'neutral') / count(*), 6) as neutral,
    round(count(*) filter (polarity = 'positive') / count(*), 6) as positive from polar where source is not null group by source"""
)
def platform_ratio(spark, d):
    out = report.platform_ratio(_polar(spark, d).withColumnRenamed("source", "platform"))
    return out.select("platform", *[F.round(p, 6).alias(p) for p in ("negative", "neutral", "positive")])


@query("select year(o_orderdate) as year, count(*) as reviews, round_even(count(*) / sum(count(*)) over () * 100, 1) as ratio from orders group by 1")
def year_ratio(spark, d):
    return report.year_ratio(table(spark, d, "orders"), F.col("o_orderdate").cast("string"))


SUMMARY = """rows as (select vec_id, label as cluster, case vec_id % 3 when 0 then 'negative' when 1 then 'neutral' else 'positive' end as polarity, case when vec_id % 7 = 0 then ' ' else 'f' || (vec_id % 5) end as facet from embeddings),
fc as (select cluster, facet, count(*) as n, min(vec_id) as o from rows where trim(facet) <> '' group by all), fm as (select cluster, min_by(facet, (-n, o)) as facet from fc group by cluster),
pc as (select cluster, polarity, count(*) as n, min(vec_id) as o from rows group by all), pm as (select cluster, min_by(polarity, (-n, o)) as polarity from pc group by cluster)"""


def _summary_rows(spark, d) -> DataFrame:
    v = F.col("vec_id")
    return _vectors(spark, d).select(
        "vec_id", F.col("label").alias("cluster"), F.when(v % 3 == 0, "negative").when(v % 3 == 1, "neutral").otherwise("positive").alias("polarity"), F.when(v % 7 == 0, " ").otherwise(F.concat(F.lit("f"), v % 5)).alias("facet")
    )


@query(
    f"""with {SUMMARY} select pm.polarity, coalesce(fm.facet, '') as facet, case when s.cluster % 2 = 0 then 'rep ' || s.cluster else '' end as rep, cnt
    from (select cluster, count(*) as cnt from rows group by cluster) s left join pm using (cluster) left join fm using (cluster)"""
)
def rep_summary(spark, d):
    rows = _summary_rows(spark, d)
    reps = rows.filter("cluster % 2 = 0").select("cluster", F.concat(F.lit("rep "), "cluster").alias("rep")).distinct()
    return report.rep_summary(rows, reps, "cluster", "polarity", "facet", "vec_id")


@query(f"with {SUMMARY} select cluster, facet from fm")
def mode_facet(spark, d):
    return report.mode_by(_summary_rows(spark, d), "cluster", "facet", "vec_id")


BLANKS = "case event_id % 6 when 0 then null when 1 then ' ' when 2 then 'nan' when 3 then '[]' when 4 then 'None' else event_type end"


def _blanks(spark, d) -> DataFrame:
    e = F.col("event_id") % 6
    return table(spark, d, "events").select("event_id", "event_type", F.when(e == 0, None).when(e == 1, " ").when(e == 2, "nan").when(e == 3, "[]").when(e == 4, "None").otherwise(F.col("event_type")).alias("facet"))


@query(f"select count(*) as total, count(f) as not_null, count(*) filter (trim(f) <> '') as filled, round_even(count(*) filter (trim(f) <> '') / count(*) * 100, 1) as pct from (select {BLANKS} as f from events)")
def facet_coverage(spark, d):
    return report.facet_coverage(_blanks(spark, d), "facet")


@query(f"select event_id, case when trim(f) in ('', 'nan', 'None', '[]', '{{}}') then null else f end as facet from (select event_id, {BLANKS} as f from events)")
def blank_to_null(spark, d):
    return report.blank_facets_to_null(_blanks(spark, d), "facet").select("event_id", "facet")


@query(f"select event_id, coalesce(case when trim(f) in ('', 'nan', 'None', '[]', '{{}}') then null else f end, 'new') as facet from (select event_id, {BLANKS} as f from events)")
def facet_fill(spark, d):
    return report.blank_facets_to_null(_blanks(spark, d), "facet").select("event_id", F.coalesce("facet", F.lit("new")).alias("facet"))


@query("select event_id, case when event_id % 4 = 0 then '' else event_type end as facet from events")
def materialize_bucket(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, "[]").otherwise(F.concat(F.lit('[["'), "event_type", F.lit('",0.5],["x",0.1]]'))).alias("facet_topk"))
    return rows.select("event_id", report.materialize_bucket(rows).alias("facet"))


@query("select cast(label as varchar) as cluster_label, count(*) as count from embeddings group by label")
def cluster_distribution(spark, d):
    return report.cluster_distribution(_vectors(spark, d), "label")


@query("select count(distinct case when label <> 3 then label end) as n_clusters, count(*) filter (label = 3) as n_noise, count(*) as n_samples from embeddings")
def cluster_stats(spark, d):
    return report.cluster_stats(_vectors(spark, d).withColumn("label", F.when(F.col("label") == 3, "other").otherwise(F.col("label").cast("string"))), "label")


@query("select doc_id, lang, lang || '!' as lang_2 from documents")
def clustered_reviews(spark, d):
    docs = _docs(spark, d).select("doc_id", "lang")
    return report.clustered_reviews(docs, docs.select("doc_id", F.concat("lang", F.lit("!")).alias("lang")), "doc_id", "lang")


@query("select doc_id, lang from documents order by doc_id limit 200")
def debug_head(spark, d):
    return report.debug_head(_docs(spark, d), "doc_id", ("doc_id", "missing", "lang"))


@query(
    """select coalesce(r.k, w.k) as k, coalesce(array_to_string(r.reps, '|'), '') as reps, coalesce(array_to_string(w.words, '|'), '') as words from
    (select label as k, list('v' || vec_id order by vec_id)[1:3] as reps from embeddings where label <> 2 group by label) r full join
    (select label as k, list('w' || vec_id order by vec_id desc)[1:2] as words from embeddings where label <> 5 group by label) w on r.k = w.k"""
)
def clauses_summary(spark, d):
    rows = _vectors(spark, d).select(F.col("label").alias("k"), "vec_id")
    ranked = lambda o, n, p: F.transform(F.slice(F.sort_array(F.collect_list("vec_id"), asc=o), 1, n), lambda x: F.concat(F.lit(p), x))
    reps = rows.filter("k <> 2").groupBy("k").agg(ranked(True, 3, "v").alias("representatives"))
    words = rows.filter("k <> 5").groupBy("k").agg(ranked(False, 2, "w").alias("keywords"))
    return report.clauses_summary(reps, words, "k").select("k", F.array_join("representatives", "|").alias("reps"), F.array_join("keywords", "|").alias("words"))


# ---- vectors and clusters ----------------------------------------------------------------------------------------------


@query(f"select a.vec_id, round({_cos('a.embedding', 'b.embedding')}, 6) as sim from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def cosine_sim(spark, d):
    v = _vectors(spark, d).select("vec_id", "embedding")
    nxt = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return v.join(nxt, "vec_id").select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("b")), 6).alias("sim"))


@query(f"select vec_id, i, round(x * 3 / (sqrt({_dot('w', 'w')}) + 1e-12), 6) as x from (select vec_id, w, unnest(range(len(embedding))) as i, unnest(embedding)::double as x from (select *, list_transform(embedding, lambda e: e::double * 3) as w from embeddings))")
def normalize_vec(spark, d):
    v = _vectors(spark, d).select("vec_id", F.posexplode(V.normalize(F.transform("embedding", lambda x: x.cast("double") * 3))).alias("i", "x"))
    return v.select("vec_id", "i", F.round("x", 6).alias("x"))


@query("select label, i, round(avg(x::double), 6) as m from (select label, unnest(range(len(embedding))) as i, unnest(embedding) as x from embeddings) group by all")
def centroids(spark, d):
    return C.centroids(_vectors(spark, d), "label", "embedding").select("label", F.posexplode("centroid").alias("i", "m")).select("label", "i", F.round("m", 6).alias("m"))


LABEL_CENTRES = "cent as (select label, list(m order by i) as c from (select label, i, avg(x::double) as m from (select label, unnest(range(len(embedding))) as i, unnest(embedding) as x from embeddings) group by all) group by label)"


@query(
    f"""with {LABEL_CENTRES} select label, vec_id, round(dist, 6) as dist, row_number() over (partition by label order by round(dist, 9), vec_id) as rank
    from (select e.label, vec_id, {_euclid('embedding', 'c')} as dist from embeddings e join cent using (label)) qualify rank <= 3"""
)
def representatives(spark, d):
    return C.representatives(_vectors(spark, d), "label", "embedding", "vec_id").select("label", "vec_id", F.round("dist", 6).alias("dist"), "rank")


@query(f"with {SENTENCES} select doc_id, string_agg(sentence, '|' order by case when contains(sentence, 'the') or contains(sentence, 'der') then 0 else 1 end, pos) as reps from sent group by doc_id")
def alias_first_reps(spark, d):
    docs = _docs(spark, d).select("doc_id", T.sentences(F.col("text")).alias("s")).filter(F.size("s") > 0)
    return docs.select("doc_id", F.array_join(relevance.alias_first(F.col("s"), ["the", "der"]), "|").alias("reps"))


FACETS = "fac as (select 'f' || label as id, min_by(embedding, vec_id) as emb from embeddings group by label)"
ROUTED = f"""{FACETS}, routed as (select vec_id, id as facet_id, round({_cos('e.embedding', 'f.emb')}, 9) as score, row_number() over (partition by vec_id order by round({_cos('e.embedding', 'f.emb')}, 9) desc, id) as rank
  from embeddings e, fac f qualify rank <= 2)"""


def _facets(spark, d) -> DataFrame:
    return _vectors(spark, d).groupBy("label").agg(F.min_by("embedding", "vec_id").alias("emb")).select(F.concat(F.lit("f"), "label").alias("id"), "emb")


@query(f"with {ROUTED} select vec_id, rank, facet_id, round(score, 6) as score from routed where score >= 0.1")
def facet_routing(spark, d):
    out = C.facet_routing(_vectors(spark, d), "vec_id", "embedding", _facets(spark, d), 2, 0.1)
    return out.select("vec_id", "rank", "facet_id", F.round("score", 6).alias("score"))


@query(
    f"""with {ROUTED}, good as (select vec_id, max(case when rank = 1 then facet_id end) as t, '[' || string_agg('["' || facet_id || '",' || printf('%.4f', score) || ']', ',' order by rank) || ']' as k from routed where score >= 0.1 group by vec_id)
    select vec_id, case when vec_id % 9 = 0 then 'old' else t end as facet_top1, k as facet_topk from embeddings left join good using (vec_id)"""
)
def facet_annotate(spark, d):
    rows = _vectors(spark, d).withColumn("facet_top1", F.when(F.col("vec_id") % 9 == 0, "old").when(F.col("vec_id") % 9 == 1, " "))
    return C.facet_annotate(rows, "vec_id", "embedding", _facets(spark, d), 2, 0.1).select("vec_id", "facet_top1", "facet_topk")


@query(f"with {PAIRS} select cid1, cid2, round(sim, 4) as sim from pairs where sim >= {NEAR}")
def merge_candidates(spark, d):
    return C.merge_candidates(_items(spark, d), "g", "v", NEAR).select("cid1", "cid2", F.round("sim", 4).alias("sim"))


@query(f"with {PAIRS} select cid1, cid2, round(sim, 4) as sim from pairs where sim >= {NEAR} and cid1 % 3 = cid2 % 3")
def merge_candidates_facet(spark, d):
    items = _items(spark, d).withColumn("f", F.col("g") % 3)
    return C.merge_candidates(items, "g", "v", NEAR, facet="f").select("cid1", "cid2", F.round("sim", 4).alias("sim"))


@query(f"with {PAIRS} select round(coalesce(quantile_cont(sim, 0.9), 0.999), 6) as threshold from pairs")
def dynamic_threshold(spark, d):
    return C.dynamic_threshold(_pairs(spark, d), 90).select(F.round("threshold", 6).alias("threshold"))


MAPPED = f"""{PAIRS}, e as (select cid1 as a, cid2 as b from pairs where sim >= {NEAR} union select cid2, cid1 from pairs where sim >= {NEAR}),
reach(n, r) as (select g, g from items union select e.b, reach.r from reach join e on e.a = reach.n),
mapped as (select n as old, dense_rank() over (order by r) - 1 as new from (select n, min(r) as r from reach group by n))"""


def _mapped(spark, d) -> DataFrame:
    items = checkpointed(_items(spark, d))
    return C.merge_map(items, C.merge_candidates(items, "g", "v", NEAR), "g")


@query(f"with recursive {MAPPED} select old, new from mapped")
def merge_map(spark, d):
    return _mapped(spark, d)


@query(
    f"""with recursive {MAPPED}, reps as (select vec_id % 40 as g, label, min(vec_id) as o from embeddings group by all)
    select new, string_agg(label, ',' order by f) as reps from (select new, label, min(g * 1000000 + o) as f from reps join mapped on g = old group by all) group by new"""
)
def merged_reps(spark, d):
    reps = _vectors(spark, d).withColumn("g", F.col("vec_id") % 40).groupBy("g").agg(report.first_seen("vec_id", "label").alias("reps"))
    out = C.merged_reps(reps, _mapped(spark, d), "g", "reps")
    return out.select("new", F.array_join(F.transform("reps", lambda x: x.cast("string")), ",").alias("reps"))


@query(f"with recursive {MAPPED} select vec_id, coalesce(new, vec_id % 45) as g from embeddings left join mapped on vec_id % 45 = old")
def merge_apply(spark, d):
    return C.apply_map(_vectors(spark, d).select("vec_id", (F.col("vec_id") % 45).alias("g")), "g", _mapped(spark, d))


def _silhouette(distance: str) -> str:
    return f"""with m as (select a.vec_id, a.label, b.label as o, avg({distance}) as d from embeddings a join embeddings b on a.vec_id <> b.vec_id group by all),
    ab as (select vec_id, label, max(case when o = label then d end) as a, min(case when o <> label then d end) as b from m group by all)
    select vec_id, label, round(case when a is null then 0 else (b - a) / greatest(a, b) end, 5) as sil from ab"""


@query(_silhouette(f"1 - {_cos('a.embedding', 'b.embedding')}"))
def silhouette_cosine(spark, d):
    return C.silhouette_cosine(_vectors(spark, d), "vec_id", "label", "embedding").withColumn("sil", F.round("sil", 5))


@query(_silhouette(_euclid("a.embedding", "b.embedding")))
def silhouette_euclid(spark, d):
    return C.silhouette_euclid(_vectors(spark, d), "vec_id", "label", "embedding").withColumn("sil", F.round("sil", 5))


CORE = f"""core as (select vec_id, core from (select a.vec_id, {_euclid('a.embedding', 'b.embedding')} as core, row_number() over (partition by a.vec_id order by {_euclid('a.embedding', 'b.embedding')}, b.vec_id) as r
  from embeddings a join embeddings b on a.vec_id <> b.vec_id) where r = 5)"""


@query(f"with {CORE} select vec_id, round(core, 6) as core from core")
def knn_core_dist(spark, d):
    return C.knn_core_distance(_vectors(spark, d), "vec_id", "embedding", 5).select("vec_id", F.round("core", 6).alias("core"))


@query(f"with {CORE} select a.vec_id as a, b.vec_id as b, round(greatest(p.core, q.core, {_euclid('a.embedding', 'b.embedding')}), 6) as w from embeddings a join embeddings b on a.vec_id < b.vec_id join core p on p.vec_id = a.vec_id join core q on q.vec_id = b.vec_id")
def mutual_reach(spark, d):
    v = _vectors(spark, d)
    return C.mutual_reachability(v, C.knn_core_distance(v, "vec_id", "embedding", 5), "vec_id", "embedding").select("a", "b", F.round("w", 6).alias("w"))


BLOBS = "blobs as (select vec_id, label, row_number() over (partition by label order by vec_id) as n from embeddings)"


def _blobs(spark, d, apart: float = 0.0) -> DataFrame:
    """A line of points for each label, far from those of others; with `apart` every second point lies on a second line."""
    n = F.row_number().over(W.partitionBy("label").orderBy("vec_id"))
    rows = _vectors(spark, d).select("vec_id", "label", n.alias("n"))
    return rows.select("vec_id", "label", F.lit(0).alias("all"), F.array(F.col("label") * 1000.0, F.col("n") * 0.01 + (F.col("n") % 2) * F.lit(apart)).alias("v"))


@query(f"with {BLOBS} select vec_id, case when count(*) over (partition by label) >= 20 then min(vec_id) over (partition by label) end as first from blobs")
def hdbscan(spark, d):
    """Lines of equal steps are a cluster each, so a row is told by its cluster's first one; noise has none."""
    told = checkpointed(density.cluster_groups(_blobs(spark, d), "all", "vec_id", "v", 20, 3, 0.05))
    first = told.filter("cluster_label >= 0").groupBy("cluster_label").agg(F.min("vec_id").alias("first"))
    return told.join(first, "cluster_label", "left").select("vec_id", "first")


@query("select vec_id, round(5 * abs(vec_id % 100 - 50)::double, 6) as reduced from embeddings")
def reduce_pca(spark, d):
    """Rows on one line through (3, 0, 4): the only component is five times the step, up to its sign."""
    x = (F.col("vec_id") % 100 - 50).cast("double")
    rows = _vectors(spark, d).select("vec_id", F.array(x * 3, F.lit(0.0), x * 4).alias("v"))
    return density.reduce_pca(rows, "v", 1).select("vec_id", F.round(F.abs(F.get("reduced", 0)), 6).alias("reduced"))


TWO_LINES = f"{BLOBS}, two as (select *, n * 0.01 + (n % 2) * 50 as y, n % 2 as half, count(*) over (partition by label) as size from blobs)"


@query(
    f"""with {TWO_LINES}, m as (select a.vec_id, a.label, a.half, b.half as o, avg(abs(a.y - b.y)) as d from two a join two b on a.label = b.label and a.vec_id <> b.vec_id group by all),
    ab as (select vec_id, label, max(case when half = o then d end) as a, min(case when half <> o then d end) as b from m group by all),
    s as (select label, avg((b - a) / greatest(a, b)) as sil from ab group by label)
    select label, size as n, case when size >= 8 then 2 else 1 end as best_k, round(case when size >= 8 then sil else 0 end, 6) as sil from (select distinct label, size from two) join s using (label)"""
)
def heterogeneity(spark, d):
    return density.heterogeneity(_blobs(spark, d, 50.0), "label", "vec_id", "v").withColumn("sil", F.round("sil", 6))


@query(f"with {TWO_LINES} select label, min(vec_id) as first, count(*) as n, size >= 35 as split from two group by label, size, case when size >= 35 then half end")
def refine_split(spark, d):
    """Which half gets which number is the seed's choice, so parts are told by their first row."""
    out = density.refine_split(_blobs(spark, d, 50.0), "label", "vec_id", "v")
    parts = out.groupBy("label", "refined_label").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    return parts.select("label", "first", "n", (F.count("*").over(W.partitionBy("label")) > 1).alias("split"))


@query(
    f"""with {TWO_LINES}, {ROUTED}, top as (select vec_id, facet_id from routed where rank = 1 and score >= 0.1)
    select label, min(t.vec_id) as first, count(facet_id) as routed, min(facet_id) as facet, label % 7 as prefix from two t left join top using (vec_id) group by label, size, case when size >= 35 then half end"""
)
def refine(spark, d):
    """Facets and local splits of the same rows, and refined ids in their prefix's thousands."""
    routed = C.facet_annotate(_vectors(spark, d), "vec_id", "embedding", _facets(spark, d), 2, 0.1).select("vec_id", "facet_top1")
    split = density.refine_split(_blobs(spark, d, 50.0), "label", "vec_id", "v")
    rows = routed.join(split, "vec_id").withColumn("id", L.refined_id(F.col("label") % 7, F.col("refined_label")))
    out = rows.groupBy("label", "id").agg(F.min("vec_id").alias("first"), F.count("facet_top1").alias("routed"), F.min("facet_top1").alias("facet"), F.min("refined_label").alias("_r"))
    return out.select("label", "first", "routed", "facet", F.floor((F.col("id") - F.col("_r")) / 1000).cast("int").alias("prefix"))


@query(
    f"""with s as ({_silhouette(f"1 - {_cos('a.embedding', 'b.embedding')}").replace('from embeddings a join embeddings b', 'from used a join used b').replace('with m as', 'with used as (select * from embeddings where label <> 3), m as')}),
    e as ({_silhouette(_euclid("a.embedding", "b.embedding")).replace('from embeddings a join embeddings b', 'from used a join used b').replace('with m as', 'with used as (select * from embeddings where label <> 3), m as')})
    select (select round(avg(sil), 4) from e) as silhouette_umap, (select round(avg(sil), 4) from s) as silhouette_raw, count(distinct case when label <> 3 then label end) as n_clusters,
    count(*) filter (label = 3) as n_noise_or_other, count(*) filter (label <> 3) as n_samples_used from embeddings"""
)
def cluster_quality(spark, d):
    rows = _vectors(spark, d).withColumn("label", F.when(F.col("label") == 3, "Other").otherwise(F.col("label").cast("string")))
    out = report.cluster_quality(rows, "vec_id", "label", "embedding", "embedding")
    return out.withColumn("silhouette_umap", F.round("silhouette_umap", 4)).withColumn("silhouette_raw", F.round("silhouette_raw", 4))


@query("""select label as cluster, '{"label":' || label || ',"representatives":["v' || min(vec_id) || '"]}' as json from embeddings group by label""")
def representatives_json(spark, d):
    reps = _vectors(spark, d).groupBy("label").agg(F.array(F.concat(F.lit("v"), F.min("vec_id"))).alias("representatives"))
    return report.representatives_json(reps.withColumn("label", F.concat(F.lit(" "), "label")), "label", "representatives")


@query(
    """with n as (select source, count(*) * 37 as n from documents group by source), s as (select *, cast(round_even(n * case when n < 6000 then 0.010 else 0.005 end::double, 0) as int) as share, source in ('src0', 'src5') as bucket from n),
    t as (select *, greatest(5, least(100, share)) as near, greatest(5, share) as size, greatest(2, cast(round_even(greatest(5, share) * 0.5::double, 0) as int)) as samples from s)
    select source, n, case when bucket then cast(round_even(near * 1.15::double, 0) as int) else near end as n_neighbors, case when n < 500 then 8 when n < 2000 then 10 when n < 8000 then 12 when n < 16000 then 13 else 14 end as n_components,
    case when bucket then cast(round_even(size * 1.35::double, 0) as int) else size end as min_cluster_size, case when bucket then cast(round_even(samples * 1.15::double, 0) as int) else samples end as min_samples,
    case when bucket then 0.08::double else 0.05::double end as min_dist, round(case when bucket then 0.07::double else 0.05::double end, 6) as epsilon from t"""
)
def tuner_params(spark, d):
    n = _docs(spark, d).groupBy("source").agg((F.count("*") * 37).alias("n"))
    return C.tuner_params(n, F.col("n"), F.col("source").isin("src0", "src5")).withColumn("epsilon", F.round("epsilon", 6))


# ---- keywords ----------------------------------------------------------------------------------------------------------

TFIDF = """tok as (select {cluster} as cluster, doc_id, t as term, count(*) as tf from (select *, unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) as t from documents) where t not in ('that', 'with', 'from', 'this') group by all),
idf as (select term, ln((1.0::double + (select count(*) from documents)) / (1.0::double + count(*))) + 1 as idf from tok group by term),
w as (select cluster, doc_id, term, tf * idf as w from tok join idf using (term)), len as (select doc_id, sqrt(sum(w * w)) as l from w group by doc_id),
sc as (select w.cluster, term, sum(w / l) / any_value(nd) as score from w join len using (doc_id) join (select {cluster} as cluster, count(*) as nd from documents group by 1) n on n.cluster = w.cluster group by w.cluster, term),
top as (select cluster, term, score, row_number() over (partition by cluster order by round(score, 9) desc, term desc) as rank from sc qualify rank <= 3)"""


def _keywords(spark, d, cluster: str) -> DataFrame:
    return keywords.tfidf_keywords(_docs(spark, d).select("doc_id", cluster, "text"), cluster, "doc_id", "text", EUROPEAN.keyword, EUROPEAN.stopwords)


@query(f"with {TFIDF.format(cluster='lang')} select cluster as lang, rank, term, round(score, 6) as score from top")
def keywords_tfidf(spark, d):
    return _keywords(spark, d, "lang").select("lang", "rank", "term", F.round("score", 6).alias("score"))


@query(
    """with kw as (select label as c, ['w' || (label % 3), 'w' || (label % 4), 'x' || (label % 5)] as w from embeddings group by label),
    acc as (select list_reduce(list_prepend({'c': -1, 'w': []::varchar[], 'n': []::varchar[]}, list({'c': c::bigint, 'w': w, 'n': []::varchar[]} order by c)), lambda a, x:
      {'c': x.c, 'w': list_concat(a.w, list_filter(x.w, lambda t: not list_contains(a.w, t))[1:2]),
       'n': list_append(a.n, array_to_string(list_concat(list_filter(x.w, lambda t: not list_contains(a.w, t))[1:2], x.w[1:greatest(0, 2 - len(list_filter(x.w, lambda t: not list_contains(a.w, t))[1:2]))]), '·'))}) as a from kw),
    names as (select unnest(a.n) as name, unnest(range(len(a.n))) as i from acc)
    select c as label, name from names join (select c, row_number() over (order by c) - 1 as i from kw) using (i)"""
)
def cluster_names(spark, d):
    c = F.col("label")
    words = F.array(F.concat(F.lit("w"), c % 3), F.concat(F.lit("w"), c % 4), F.concat(F.lit("x"), c % 5))
    return C.cluster_names(_vectors(spark, d).select("label").distinct().withColumn("w", words), "label", "w").withColumn("label", F.col("label").cast("int"))


@query("select doc_id, lang from documents qualify row_number() over (partition by lang order by md5('0|' || doc_id), doc_id) <= 50")
def sample_docs(spark, d):
    return keywords.sample_docs(_docs(spark, d).select("doc_id", "lang"), "doc_id", "lang", 50, 0)


@query()
def keybert_like(spark, d):
    return keywords.keybert_like(_docs(spark, d), "lang", "doc_id", "text", EUROPEAN.keyword, 64)


# ---- relevance ---------------------------------------------------------------------------------------------------------

DIMS = 16
ALIASES, TERMS, BANNED = ["thing", "haus", "thing", ""], ["que", "und der", "the and", "los"], ["clown", "idiot"]


def _embed_sql(x: str) -> str:
    counts = f"list_transform(range({DIMS}), lambda i: len(list_filter(regexp_extract_all(lower({x}), '[A-Za-z]{{2,}}'), lambda t: ('0x' || substr(md5(t), 1, 8))::bigint % {DIMS} = i))::double)"
    return f"list_transform({counts}, lambda z: z / greatest(sqrt(list_inner_product({counts}, {counts})), 1e-300))"


EMBEDDED = f"""counted as (select doc_id, text, list_transform(range({DIMS}), lambda i: len(list_filter(b, lambda t: t = i))::double) as n from
  (select doc_id, text, list_transform(regexp_extract_all(lower(text), '[A-Za-z]{{2,}}'), lambda t: ('0x' || substr(md5(t), 1, 8))::bigint % {DIMS}) as b from documents)),
emb as (select doc_id, text, case when list_sum(n) > 0 then list_transform(n, lambda x: x / sqrt(list_inner_product(n, n))) else n end as v from counted),
qs as (select k, {_embed_sql('q')} as q from (values ('a', 'thing'), ('a', 'haus'), ('f', 'que'), ('f', 'und der'), ('f', 'the and'), ('f', 'los')) t(k, q)),
sims as (select doc_id, any_value(text) as text, max(case when k = 'a' then list_inner_product(v, q) end) as alias_sim, max(case when k = 'f' then list_inner_product(v, q) end) as facet_sim from emb, qs group by doc_id),
scored as (select *, greatest(alias_sim, facet_sim) + {BONUS.format(x='text')} as total, contains(text, 'thing') or contains(text, 'haus') as named, contains(text, 'clown') or contains(text, 'idiot') as banned from sims)"""


def _scored(spark, d) -> DataFrame:
    docs = _docs(spark, d).select("doc_id", "text", V.hash_embed(T.tokens(F.lower("text"), EUROPEAN.token), DIMS).alias("v"))
    return relevance.dual_relevance(docs, "v", "text", ALIASES, TERMS, BONUS_TERMS, EUROPEAN.token, DIMS)


@query(f"with {EMBEDDED} select doc_id, i, round(x, 6) as x from (select doc_id, unnest(range(len(v))) as i, unnest(v) as x from emb)")
def hash_embed(spark, d):
    docs = _docs(spark, d).select("doc_id", F.posexplode(V.hash_embed(T.tokens(F.lower("text"), EUROPEAN.token), DIMS)).alias("i", "x"))
    return docs.select("doc_id", "i", F.round("x", 6).alias("x"))


@query(f"with {EMBEDDED} select doc_id, round(alias_sim, 6) as alias_sim, round(facet_sim, 6) as facet_sim, round(total, 6) as total from scored")
def dual_relevance(spark, d):
    return _scored(spark, d).select("doc_id", *[F.round(c, 6).alias(c) for c in ("alias_sim", "facet_sim", "total")])


@query(f"with {EMBEDDED} select doc_id, round(greatest(alias_sim, facet_sim) + {BONUS.format(x='text')}, 6) as score from sims")
def score_relevance(spark, d):
    docs = _docs(spark, d).select("doc_id", "text", V.hash_embed(T.tokens(F.lower("text"), EUROPEAN.token), DIMS).alias("v"))
    sim = relevance.max_similarity(F.col("v"), T.build_queries([*ALIASES, *TERMS], 32), EUROPEAN.token, DIMS)
    return docs.select("doc_id", F.round(sim + T.lexical_bonus(F.col("text"), BONUS_TERMS), 6).alias("score"))


@query(f"with {EMBEDDED} select doc_id, (named or alias_sim >= 0.40) and (not banned or named) and total >= 0.40 as kept from scored")
def relevance_gate(spark, d):
    s = _scored(spark, d)
    return s.select("doc_id", relevance.gate(F.col("text"), F.col("alias_sim"), F.col("total"), ALIASES, BANNED, 0.40, 0.40, "soft").alias("kept"))


@query(f"with {EMBEDDED} select doc_id from scored where total >= 0.5")
def keep_mask(spark, d):
    return _scored(spark, d).filter("total >= 0.5").select("doc_id")


@query(
    """select doc_id, mode, case when mode = 'off' then true else not (contains(text, 'clown') or contains(text, 'idiot')) or contains(text, 'thing') or contains(text, 'haus') end as kept
    from documents, (values ('strict'), ('soft'), ('off')) m(mode)"""
)
def ban_modes(spark, d):
    docs = _docs(spark, d)
    one = lambda m: docs.select("doc_id", F.lit(m).alias("mode"), relevance.gate(F.col("text"), F.lit(1.0), F.lit(1.0), ALIASES, BANNED, 0.4, 0.4, m).alias("kept"))
    return S.union_tables(*map(one, ("strict", "soft", "off")))


def _extract_sql(parts: str, most: int) -> str:
    score = r"(length(s) / 100.0::double + (case when regexp_matches(s, '[\[\](){}“”\"'']') then 0.05 else 0.0 end::double + case when regexp_matches(s, '\p{Nd}') then 0.05 else 0.0 end::double))"
    return f"""ranked as (select key, s, pos, n, row_number() over (partition by key order by -{score}, pos) as r, row_number() over (partition by key, substr(s, 1, 32) order by -{score}, pos) as f
      from (select key, len(p) as n, unnest(p) as s, unnest(range(len(p))) as pos from {parts})),
    picked as (select key, s, row_number() over (partition by key order by r) - 1 as i from ranked where f = 1 and n > {most} qualify i < {most} union all select key, s, pos from ranked where n <= {most})"""


@query(f"with parts as (select doc_id as key, {_posts_pieces('text')} as p from documents), {_extract_sql('parts', 5)} select key as doc_id, i, s as sentence from picked")
def extractive_summary(spark, d):
    parts = relevance.extractive_summary(T.community_sentences(F.col("text")), 5)
    return _docs(spark, d).select("doc_id", F.posexplode(parts).alias("i", "sentence"))


SUMMARIZED = f"""{POSTS}, given as (select post_id as key, {_posts_pieces(_strip('summary'))} as p, {_strip('summary')} as t from posts),
free as (select post_id as key, {_posts_pieces(_strip(f"{_strip('title')} || chr(10) || {_strip('body')}"))} as p from posts where {_strip('summary')} = ''), {_extract_sql('free', 3)},
told as (select key, i, s from picked union all select key, unnest(range(least(3, len(p)))) as i, unnest(p[1:3]) as s from given where t <> '')"""


def _summarized(spark, d) -> DataFrame:
    return _posts(spark, d).withColumn("parts", relevance.summarize_row(F.col("title"), F.col("body"), F.col("summary"), 3))


@query(f"with {SUMMARIZED} select key as post_id, i, s as sentence from told")
def summarize_row(spark, d):
    return _summarized(spark, d).select("post_id", F.posexplode("parts").alias("i", "sentence"))


@query(f"with {SUMMARIZED} select key as post_id, i as sent_pos, s as sentence, platform, row_number() over (order by key, i) as serial from told join posts on key = post_id")
def flatten_sentences(spark, d):
    return relevance.flatten_sentences(_summarized(spark, d), F.col("parts"), "post_id").select("post_id", "sent_pos", "sentence", "platform", "serial")


@query(f"with {SENTENCES}, n as (select doc_id, sentence, row_number() over (order by doc_id, pos) as serial from sent) select doc_id || '-s' || serial as id, sentence from n where length(sentence) > 30")
def sentence_serial(spark, d):
    docs = _docs(spark, d).select("doc_id", "text")
    flat = relevance.flatten_sentences(docs, T.sentences(F.col("text")), "doc_id").filter(F.length("sentence") > 30)
    return flat.select(F.concat("doc_id", F.lit("-s"), "serial").alias("id"), "sentence")


@query(
    f"""with {EMBEDDED}, k as (select *, (named or alias_sim >= 0.40) and (not banned or named) and total >= 0.40 as kept from scored)
    select count(*) as total_sentences, count(*) filter (kept) as kept_sentences, round(avg(kept::int::double), 6) as keep_rate, round(avg(named::int::double), 6) as alias_hit_rate_all,
    round(coalesce(avg(named::int::double) filter (kept), 0), 6) as alias_hit_rate_kept, count(*) filter (banned and not kept) as banned_excluded from k"""
)
def filter_stats(spark, d):
    s = _scored(spark, d)
    kept = relevance.gate(F.col("text"), F.col("alias_sim"), F.col("total"), ALIASES, BANNED, 0.40, 0.40, "soft")
    out = relevance.filter_stats(s.withColumn("kept", kept).withColumn("alias_hit", T.contains_any(F.col("text"), ALIASES)).withColumn("banned", T.contains_any(F.col("text"), BANNED)))
    return out.select(*[F.round(c, 6).alias(c) if c.endswith("rate") or "rate_" in c else c for c in out.columns])


# ---- labels and ids ----------------------------------------------------------------------------------------------------


@query("select vec_id, case vec_id % 3 when 0 then 0 when 1 then 1000 else 2000 end + case when label = 4 then 999 else label end as label from embeddings")
def label_offset(spark, d):
    rows = _summary_rows(spark, d)
    return rows.select("vec_id", L.label_offset(F.when(F.col("cluster") == 4, -1).otherwise(F.col("cluster")), F.col("polarity")).alias("label"))


@query("select vec_id, case vec_id % 6 when 0 then -1 when 1 then -1 when 2 then -1 when 3 then -1 when 4 then -1 else label end as label from embeddings")
def coerce_label(spark, d):
    v = F.col("vec_id") % 6
    raw = F.when(v == 0, "other").when(v == 1, "-1").when(v == 2, "NaN").when(v == 3, None).when(v == 4, "x").otherwise(F.concat(F.lit(" "), "label", F.lit(" ")))
    return _vectors(spark, d).select("vec_id", L.coerce_label(raw).alias("label"))


@query("select vec_id, (vec_id % 3) * 1000 + case when label = 4 then 999 else label end as refined_cluster_id from embeddings")
def refined_id(spark, d):
    return _vectors(spark, d).select("vec_id", L.refined_id(F.col("vec_id") % 3, F.when(F.col("label") == 4, -1).otherwise(F.col("label"))).alias("refined_cluster_id"))


SIGS = """sigs as (select c, substr(sha1(case when t = '' then 'cluster:' || c else t end), 1, 16) as sig from
  (select (label % 3) * 1000 + case when label = 4 then 999 else label * 3 + vec_id % 3 end as c, lower(case when label = 7 then '' when label in (2, 5) then 'Same Text' else 'V' || label || ' v' || (vec_id % 3) end) as t from embeddings group by all))"""


def _sigs(spark, d) -> DataFrame:
    label, v = F.col("label"), F.col("vec_id") % 3
    reps = F.when(label == 7, F.array().cast("array<string>")).when(label.isin(2, 5), F.array(F.lit("Same"), F.lit("Text"))).otherwise(F.array(F.concat(F.lit("V"), label), F.concat(F.lit("v"), v)))
    rows = _vectors(spark, d).select(((label % 3) * 1000 + F.when(label == 4, 999).otherwise(label * 3 + v)).cast("long").alias("c"), reps.alias("r")).distinct()
    return rows.select("c", T.signature(F.col("r"), F.col("c")).alias("sig"))


@query(f"with {SIGS} select c, sig from sigs")
def signature(spark, d):
    return _sigs(spark, d)


@query(
    f"""with {SIGS}, one as (select sig, min(c) as c from sigs where c % 1000 <> 999 group by sig), n as (select sig, c // 1000 as p, 1000 + row_number() over (partition by c // 1000 order by c) as n from one)
    select s.c, s.sig, p * 1000 + case when n.n % 1000 = 999 then 998 else n.n % 1000 end as stable_id from sigs s join n using (sig) where s.c % 1000 <> 999 union all select c, sig, c from sigs where c % 1000 = 999"""
)
def stable_ids(spark, d):
    return C.stable_ids(_sigs(spark, d), "c", "sig")


# ---- generic shapes ----------------------------------------------------------------------------------------------------


@query("select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem group by rollup(l_returnflag, l_linestatus)")
def lineitem_rollup(spark, d):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.sum(revenue), 2).alias("revenue"), F.count("*").alias("n"))


@query("select c_custkey, o_orderkey, rank from (select c_custkey, o_orderkey, row_number() over (partition by c_custkey order by o_totalprice desc, o_orderkey) as rank from customer left join orders on c_custkey = o_custkey) where rank <= 3")
def top_orders(spark, d):
    joined = table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), F.col("c_custkey") == F.col("o_custkey"), "left")
    w = W.partitionBy("c_custkey").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey")
    return joined.select("c_custkey", "o_orderkey", F.row_number().over(w).alias("rank")).filter("rank <= 3")


def flagship(spark, d) -> DataFrame:
    """Reviews to cleaned clauses, lexicon polarity and the platform block."""
    base = preprocess.with_review_id(preprocess.preprocess(_reviews(spark, d).drop("review_id"), "doc_id"), "doc_id")
    told = plans.polarized(base, SETTINGS)
    return report.platform_block(base, told.join(base.select("review_id", "platform"), "review_id"))
