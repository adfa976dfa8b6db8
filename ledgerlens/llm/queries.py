"""The checked query of each operator, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import held_out
from .contexts import score_texts
from .darts import near_duplicates
from .fingerprints import fingerprints
from .mixing import mix_sources
from .negatives import mine_negatives
from .neighbours import link_near_vectors
from .packing import pack_best_fit, token_pieces
from .quality import classify_quality, fit_quality
from .sharding import shard_by_bytes
from .substrings import drop_repeats
from .urls import judge_urls
from .variants import spelling_variants, word_counts
from .warc import read_archive, write_archive

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


MIX_SQL = r"""
with recursive counted as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as n_tokens,
         md5('0:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as h
  from documents
), sources as (
  select source, sum(n_tokens)::bigint as t from counted group by 1
), shares as (
  select t / (select sum(t) from sources) as p from sources where t > 0
), halving(low, high) as (
  select -1::bigint, 16777216::bigint
  union all
  select case when flat then mid else low end, case when flat then high else mid end from (
    select low, high, mid,
           (select ln(sum(pow(p, e))) - e * sum(pow(p, e) * ln(p)) / sum(pow(p, e)) >= 0.95 * ln(count(*)) - 1e-12 from shares) as flat
    from (select low, high, (low + high) // 2 as mid, ((low + high) // 2) * (8.0::double / 16777216) as e
          from halving where high - low > 1)
  )
), chosen as (
  select max(high - 1) * (8.0::double / 16777216) as e from halving where high - low = 1
), quotas as (
  select source, t, case when t > 0 then round(pow(t / (select sum(t) from sources), (select e from chosen))
           / (select sum(pow(p, (select e from chosen))) from shares) * (select sum(t) from sources))::bigint else 0 end as quota
  from sources
), blocks as (
  select greatest(1, ceil((select sum(t) from sources) / 1000000))::bigint as n
), placed as (
  select c.doc_id, c.source, c.n_tokens, c.h, q.t, q.quota,
         coalesce(sum(c.n_tokens) over (partition by c.source order by c.h rows between unbounded preceding and 1 preceding), 0)::bigint as before,
         case when q.t > 0 then q.quota // q.t else 0 end as passes
  from counted c join quotas q on c.source is not distinct from q.source
), copies as (
  select *, unnest(range(0, passes + case when t = 0 or (quota - passes * t > 0 and before + n_tokens <= quota - passes * t) then 1 else 0 end)) as copy
  from placed
), positioned as (
  select *, case when quota > 0 then least(((copy * t + before) * n) // greatest(quota, 1), n - 1)
                 else ('0x' || substr(h, 1, 8))::bigint % n end as block
  from copies, blocks
)
select doc_id, source, n_tokens, quota, (select e from chosen) as exponent, copy::integer as copy, block,
       row_number() over (partition by block order by md5(copy::varchar || ':' || block::varchar || ':' || h)) - 1 as position
from positioned
"""


@query("op1_mix_sources", MIX_SQL)
def op1(spark, d):
    """Sources flattened to 95 % of the largest entropy, over as many tokens as the corpus has."""
    mixed = mix_sources(table(spark, d, "documents"), target_entropy=0.95)
    return mixed.select("doc_id", "source", "n_tokens", "quota", "exponent", "copy", "block", "position")


ARCHIVE_SQL = r"""
with facts as (
  select page_id, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') as url, coalesce(html, '') as payload from pages
), hashed as (
  select page_id, url, payload, strlen(payload)::bigint as payload_bytes, sha1(payload) as h,
         min(page_id) over (partition by payload) as least
  from facts
), digested as (
  select *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
              ((('0x' || substr(h, 5 * (i // 4)::int + 1, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '') as payload_digest
  from hashed
)
select page_id, payload_bytes, payload_digest, case when page_id = least then 'response' else 'revisit' end as record_type,
       case when page_id <> least then least end as refers_to, nullif(url, '') as url, payload_digest as stated_digest
from digested
"""


@query("op5_warc_archive", ARCHIVE_SQL)
def op5(spark, d):
    records = read_archive(spark, write_archive(table(spark, d, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "stated_digest")


@query("op6_byte_shards")
def op6(spark, d):
    docs = table(spark, d, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    rows = shard_by_bytes(docs, 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Rules of the contract (fixed values).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

URL_SQL = r"""
with parts as (
  select page_id, url,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages
), rules(h, p, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), urls as (select distinct url, host, path from parts), fits as (
  select url, h || p as rule, verdict, row_number() over (partition by url order by length(h || p) desc, verdict, h || p) as n
  from urls join rules on (host = h or host like '%.' || h) and starts_with(path, p)
), ruled as (select url, rule, verdict from fits where n = 1),
-- without redirects or canonical links an url's only aliases are those that differ in the fragment
blocked as (
  select distinct regexp_replace(u.url, '#.*$', '', 's') as bare from urls u join ruled using (url) where verdict = 'block'
)
select page_id, host, path, rule,
       coalesce(verdict, case when regexp_replace(url, '#.*$', '', 's') in (select bare from blocked) then 'block' else 'allow' end) as verdict
from parts left join ruled using (url)
"""


@query("op8_url_aliases", URL_SQL)
def op8(spark, d):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, d, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op10_best_fit_packing")
def op10(spark, d):
    pieces = token_pieces(table(spark, d, "documents")).drop("ids")
    return pack_best_fit(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_pairwise_quality")
def op2(spark, d):
    """Learns only from rows whose crc32 of the id leaves another remainder than 2 by 4."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = fit_quality(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)))
    rows = classify_quality(docs, model)
    return rows.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


@query("op3_dart_minhash")
def op3(spark, d):
    rows = near_duplicates(table(spark, d, "documents"))
    return rows.select("doc_id", "class_id", "kept")


@query("op7_weighted_fingerprints")
def op7(spark, d):
    return fingerprints(table(spark, d, "documents"))


VECTORS_SQL = r"""
with recursive usable as materialized (
  select vec_id, label, embedding::double[] as v, len(embedding) as dim from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and a.dim = b.dim and a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.93
), reached(a, b) as (
  select vec_id, vec_id from usable
  union
  select r.a, l.b from reached r join links l on l.a = r.b
), counted as (select a, count(*)::bigint as n from links group by 1), least as (select a, min(b) as c from reached group by 1)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(c, vec_id) as component_id, coalesce(c, vec_id) = vec_id as kept
from embeddings left join counted on counted.a = vec_id left join least on least.a = vec_id
"""


@query("op9_projection_passes", VECTORS_SQL)
def op9(spark, d):
    return link_near_vectors(table(spark, d, "embeddings"))


@query("op4_context_tree")
def op4(spark, d):
    """Learns only from rows whose crc32 of the id leaves another remainder than 2 by 7."""
    out = held_out(F.col("doc_id"), 7, 2)
    rows = score_texts(table(spark, d, "documents"), ~out)
    return rows.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


REPEATS_SQL = r"""
with split as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), runs as (
  select r, doc_id, i, array_to_string(w[i : i + 12], ' ') as run from (select *, unnest(range(1, len(w) - 11)) as i from split where len(w) >= 13)
), late as (
  select r, i from (select r, i, doc_id, min(doc_id) over (partition by run) as least from runs) where least < doc_id
), gone as (
  select distinct r, unnest(range(i, i + 13)) as at from late
), words as (
  select r, doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as at from split
), kept as (
  select words.r, count(gone.at)::bigint as n_removed, coalesce(string_agg(word, ' ' order by words.at) filter (where gone.at is null), '') as left_over
  from words left join gone on words.r = gone.r and words.at = gone.at group by 1
)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(left_over, '')) as kept_sha256
from split left join kept using (r)
"""


@query("op11_fixed_block_anchors", REPEATS_SQL)
def op11(spark, d):
    rows = drop_repeats(table(spark, d, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


VARIANTS_SQL = r"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t
), found as (
  select coalesce(doc_id::varchar, '') as name, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents
), counted as (
  select run, hex(encode(name || ':' || run)) as bytes, count(*) as n from found where length(run) >= 7 group by name, run
), hashed as (
  select run, n, xor(list_reduce(list_transform(range(len(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::bigint),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
  from counted, crc_table
), edited as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed
), words as materialized (
  select word, sum(n)::bigint as n from edited where length(word) >= 7 group by 1 having sum(n) >= 2
), gaps as materialized (
  select word, substr(word, 1, i - 1) as l, substr(word, i + 1) as r from (select word, unnest(range(1, length(word) + 1)) as i from words)
), near as materialized (
  select distinct a.word, b.word as other from gaps a join gaps b on a.l = b.l and a.r = b.r and a.word <> b.word
  union select a.word, w.word from gaps a join words w on a.l || a.r = w.word
  union select w.word, a.word from gaps a join words w on a.l || a.r = w.word
), best as (
  select near.word, count(*) as n_near, max(w.n) as most, min(near.other) filter (where w.n = m.most) as form
  from near join words w on w.word = near.other
       join (select near.word, max(w.n) as most from near join words w on w.word = near.other group by 1) m on m.word = near.word
  group by 1
), formed as materialized (
  select word, n, coalesce(n_near, 0)::bigint as n_near, case when most >= 10 * n then form end as form, case when most >= 10 * n then most end::bigint as form_n
  from words left join best using (word)
), steps(word, here, depth) as (
  select word, word, 0 from words
  union all
  select s.word, f.form, s.depth + 1 from steps s join formed f on f.word = s.here where f.form is not null
)
select word, n, n_near, form, form_n, (select arg_max(here, depth) from steps s where s.word = formed.word) as root from formed
"""


@query("op12_permuterm_variants", VARIANTS_SQL)
def op12(spark, d):
    """The contract's words: runs of letters, one in 31 of which has lost a letter."""
    words = word_counts(table(spark, d, "documents"), shortest=7, least=2, typo_every=31)
    return spelling_variants(words, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


NEGATIVES_SQL = r"""
with rows as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
), scored as materialized (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
  select anchor_id, other as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, other)::integer as rank,
       other as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""


@query("op13_angular_negatives", NEGATIVES_SQL)
def op13(spark, d):
    """Anchors are the rows whose id 100 divides; labels of ids that 7 divides are moved on by one, as the contract asks."""
    rows = table(spark, d, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine_negatives(rows, F.col("vec_id") % 100 == 0)
