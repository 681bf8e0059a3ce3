"""The registered query of every operator here, over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import chat, chunks, hyperminhash, langmodel, lexical, mixing, packing, permuterm, revisits, sequencefile, sharding, spherical, toxicity
from tidemark.plans.catalog import query, table
from tidemark.session import checkpoint_folder

MIX_SQL = r"""
with docs as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size from documents
), per_source as (
    select source, sum(size)::bigint source_size from docs group by source
), weighed as (
    select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double weight from per_source
), ratios as (
    select *, source_size * 3.0::double / weight ratio from weighed
), levels as (
    select *, (sum(source_size) over () - coalesce(sum(source_size) over (
            order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0) * 3.0::double)
        / sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following) as lev
    from ratios
), targets as (
    select *, least(source_size * 3.0::double, max(lev) over () * weight) target from levels
), rates as (
    select *, case when source_size > 0 then target / source_size else 0 end rate from targets
), drawn as (
    select d.doc_id, d.source, d.size, r.source_size, r.target, r.rate, (r.rate - floor(r.rate)) * r.source_size asked,
        ('0x' || substr(md5('mix:' || coalesce(d.doc_id::varchar, '')), 1, 13))::bigint / 4503599627370496.0::double u
    from docs d join rates r on d.source is not distinct from r.source
), large as (
    select source, sum(size) used, max({'size': size, 'u': u}) largest from (
        select *, sum(size) over (partition by source order by size, u) upto from drawn where size * 8 > source_size and asked > 0
    ) where upto <= asked group by source
), ranges as (
    select source, floor(u * 65536)::int r, sum(size) size, any_value(asked) asked from drawn where size * 8 <= source_size and asked > 0 group by all
), cuts as (
    select x.source, max(r) + 1 cut from (select *, 2 * sum(size) over (partition by source order by r) - size twice from ranges) x
    left join large l on x.source is not distinct from l.source where twice <= 2 * (asked - coalesce(used, 0)) group by all
)
select d.doc_id, d.size, d.source_size, d.target,
    (d.size * (floor(d.rate) + coalesce(case when d.size * 8 > d.source_size then {'size': d.size, 'u': d.u} <= l.largest
        else floor(d.u * 65536) < c.cut end, false)::int))::bigint taken
from drawn d left join large l on d.source is not distinct from l.source left join cuts c on d.source is not distinct from c.source
"""


NEAR_SQL = r"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') w from documents
), s as (
    select distinct doc_id, array_to_string(w[i : i + 3], ' ') s from (
        select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from w where len(w) > 0)
), n as (
    select doc_id, count(*) n from s group by doc_id
), common as (
    select x.doc_id a, y.doc_id b, count(*) c from s x join s y on x.s = y.s and x.doc_id < y.doc_id group by all
), links as (
    select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), pairs as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id a, doc_id b from documents union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a
), least_of as (
    select a, min(b) c from reach group by a
)
select d.doc_id, coalesce(n.n, 0) n_shingles, c component_id, d.doc_id = c kept
from documents d left join n using (doc_id) join least_of on a = d.doc_id
"""


@query("op1_hyperminhash", NEAR_SQL)
def near_duplicate_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document, on 4-word shingles."""
    return hyperminhash.near_duplicates(table(spark, folder, "documents"), width=4)


REVISIT_SQL = r"""
with crawl as (
    select page_id, url, md5(coalesce(html, '')) tag, strlen(coalesce(html, '')) size from pages
), records as (
    select page_id * 8 record_id, url, page_id time, true fullrec, tag etag, size from crawl
    union all select page_id * 8 + 1, upper(split_part(url, '://', 1)) || '://' || split_part(url, '://', 2) || '#again', page_id + 1000000, false, tag, size from crawl
    union all select page_id * 8 + 2, url, page_id + 2000000, true, md5(tag || '2'), size from crawl where page_id % 3 = 0
    union all select page_id * 8 + 3, url, page_id + 3000000, false, tag, size from crawl
    union all select page_id * 8 + 4, url, page_id + 3000000, false, null, size from crawl where page_id % 5 = 0
    union all select page_id * 8 + 5, url, page_id - 1, false, tag, size from crawl where page_id % 7 = 0
), bared as (
    select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') bare from records
), pathed as (
    select *, regexp_replace(split_part(bare, '?', 1), '/+$', '') path,
        list_sort([p for p in string_split(case when instr(bare, '?') > 0 then regexp_replace(bare, '^[^?]*\?', '') else '' end, '&')
            if p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')]) kept from bared
), placed as (
    select *, regexp_replace(regexp_replace(lower(split_part(path, '/', 1)), '^www\.', ''), ':(80|443)$', '')
        || case when instr(path, '/') > 0 then regexp_replace(path, '^[^/]*', '') else '' end
        || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end canonical_url from pathed
), filled as (
    select *, last_value(case when fullrec then {'id': record_id, 'etag': etag, 'size': size} end ignore nulls) over (
        partition by canonical_url order by time nulls first, record_id, fullrec rows between unbounded preceding and 1 preceding) was from placed
)
select record_id, canonical_url,
    case when canonical_url is null or was is null then 'orphan' when etag <> was.etag then 'mismatch' when etag = was.etag then 'resolved' else 'unchecked' end status,
    case when canonical_url is not null then was.id end refers_to,
    case when canonical_url is not null and was is not null and not coalesce(etag <> was.etag, false) then
        'cache-control=no-cache|content-length=' || was.size || '|content-type=text/html|date=' || time || '|etag=' || coalesce(etag, was.etag) end headers
from filled where not fullrec
"""


@query("op2_warc_revisits", REVISIT_SQL)
def archive_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Revisits of every page, resolved. The crawl is derived from the pages: each is fetched in full and revisited
    with its validator, some change in between, some revisits have no validator or come before the first response."""
    html = F.coalesce("html", F.lit(""))
    crawl = table(spark, folder, "pages").select("page_id", "url", F.md5(html.cast("binary")).alias("tag"), F.octet_length(html).cast("string").alias("size"))
    again = F.concat(F.upper(F.substring_index("url", "://", 1)), F.lit("://"), F.element_at(F.split("url", "://", 2), 2), F.lit("#again"))

    def record(n: int, after: int, kind: str, tag: Column, url: Column, when: Column) -> Column:
        time = F.col("page_id") + after
        head = [F.lit("Date"), time.cast("string")]
        if kind == "response":
            head += [F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size")]
        else:
            head += [F.lit("Cache-Control"), F.lit("no-cache"), F.lit("Content-Length"), F.lit("0")]
        headers = F.map_filter(F.create_map(*head, F.lit("ETag"), tag), lambda _, v: v.isNotNull())
        fields = {"record_id": F.col("page_id") * 8 + n, "url": url, "time": time, "kind": F.lit(kind), "etag": tag, "headers": headers}
        return F.when(when, F.struct(*[c.alias(k) for k, c in fields.items()]))

    page, tag, url, none = F.col("page_id"), F.col("tag"), F.col("url"), F.lit(None).cast("string")
    made = [
        record(0, 0, "response", tag, url, F.lit(True)),
        record(1, 1_000_000, "revisit", tag, again, F.lit(True)),
        record(2, 2_000_000, "response", F.md5(F.concat(tag, F.lit("2"))), url, page % 3 == 0),
        record(3, 3_000_000, "revisit", tag, url, F.lit(True)),
        record(4, 3_000_000, "revisit", none, url, page % 5 == 0),
        record(5, -1, "revisit", tag, url, page % 7 == 0),
    ]
    records = crawl.select(F.explode(F.filter(F.array(*made), lambda r: r.isNotNull())).alias("r")).select("r.*")
    records = records.withColumns({"last_modified": none, "digest": none})
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return revisits.resolve_revisits(records).withColumn("headers", F.array_join(F.array_sort(lines), "|"))


@query("op3_chat_windows")
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """What every conversation reads as, back from its formatted windows."""
    hard = "\\### Assistant: </turn> ok"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return chat.read_back(chat.chat_windows(turns.union(extra), public_tokenizers.path("byte_bpe_50k.json")))


@query("op4_chunk_fingerprint")
def chunk_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return chunks.fingerprints(table(spark, folder, "documents"))


def remainder() -> Column:
    """Documents whose remainder is 0 are held out of every training."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


@query("op5_language")
def languages(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langmodel.train(docs.filter(remainder() != 0))
    rows = docs.select("text", "doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"))
    return langmodel.identify(rows, model).select("row.doc_id", "row.held_out", "lang_pred", "score", "rejected")


@query("op6_toxicity")
def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from labels of those not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    known = table(spark, folder, "labels").select("doc_id", "toxic").filter(remainder() != 0)
    model = toxicity.train(docs, known)
    rows = docs.select("text", "doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"))
    scored = toxicity.score(rows, model)
    return scored.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


@query("op7_source_mix", MIX_SQL)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document enters the mix."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs)
    return plan.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_range_shards")
def range_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shard and slot of every document, equal texts side by side."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("digest")
    )
    cut = sharding.shard_by_splitters(docs, F.col("digest"), F.col("doc_id"), F.col("bytes"))
    return cut.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.col("row.text_crc32").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_bm25_packing")
def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


COSINE_SQL = """
with recursive v as (
    select vec_id, label, [x::double for x in embedding] e from embeddings
    where label is not null and embedding is not null and list_bool_and([x is not null and isfinite(x) for x in embedding])
        and list_bool_or([x <> 0 for x in embedding])
), pairs as (
    select x.vec_id a, y.vec_id b from v x join v y
    on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.98
), reach as (
    select vec_id a, vec_id b from embeddings union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a
)
select e.vec_id, (select count(*) from pairs where a = e.vec_id) n_links, c component_id, e.vec_id = c kept
from embeddings e join (select a, min(b) c from reach group by a) on a = e.vec_id
"""


@query("op10_spherical_cells", COSINE_SQL)
def near_duplicate_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """The links and the component of every vector."""
    return spherical.near_duplicate_vectors(table(spark, folder, "embeddings"))


@query("op11_sequence_files")
def sequence_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and digest of every document's ids, read back from the sequence files."""
    path = f"{checkpoint_folder(spark)}/sequences-{uuid.uuid4().hex}"
    sequencefile.write_sequences(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return sequencefile.read_documents(spark, path).select(
        F.col("key").alias("doc_id"), "start", F.col("length").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


VARIANT_SQL = r"""
with recursive bits as (
    select list_transform(range(256), lambda i: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, b:
        case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)) tab
), runs as (
    select doc_id, run, count(*) c from (
        select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) run from documents
    ) where length(run) > 5 group by all
), hashed as (
    select *, hex(encode(doc_id || ':' || run)) hx from runs
), digested as (
    select run, c, xor(list_reduce(list_transform(range(length(hx) // 2), lambda i: ('0x' || hx[2 * i + 1 : 2 * i + 2])::bigint),
        lambda h, b: xor(h // 256, tab[xor(h % 256, b) + 1]), 4294967295::bigint), 4294967295::bigint) h from hashed, bits
), edited as (
    select case when h % 199 = 0 then run[1 : h % length(run)] || run[h % length(run) + 2 :] else run end word, c from digested
), words as (
    select word, sum(c)::bigint n from edited where length(word) > 5 group by word having sum(c) > 4
), gaps as (
    select word, n, word[i + 2 :] || ' ' || word[1 : i] gap, i = 0 or word[i] <> word[i + 1] counts
    from (select word, n, unnest(range(length(word))) i from words)
), turned as (
    select word, n, word[i + 1 :] || ' ' || word[1 : i] gap from (select word, n, unnest(range(length(word) + 1)) i from words)
), near as (
    select a.word, b.word other, b.n from gaps a join gaps b on a.gap = b.gap and a.word <> b.word
    union all select a.word, b.word, b.n from gaps a join turned b on a.gap = b.gap where a.counts
    union all select b.word, a.word, a.n from gaps a join turned b on a.gap = b.gap where a.counts
), best as (
    select word, count(*) n_near, arg_min(other, (-n, other)) form, max(n) form_n from near group by word
), formed as (
    select w.word, w.n, coalesce(n_near, 0) n_near, case when form_n >= 5 * w.n then form end form, case when form_n >= 5 * w.n then form_n end form_n
    from words w left join best b using (word)
), roots as (
    select word, coalesce(form, word) root, form is not null moved from formed
    union all select r.word, f.form, true from roots r join formed f on r.root = f.word where r.moved and f.form is not null
), ends as (
    select r.word, arg_max(r.root, w.n) root from roots r join words w on w.word = r.root group by r.word
)
select word, form, root, n, n_near, form_n from formed join ends using (word)
"""


@query("op12_permuterm", VARIANT_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Form and root of the frequent words, after some letters of the texts were dropped."""
    found = permuterm.document_words(table(spark, folder, "documents"), shortest=6)
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
    at = (h % F.length("word")).cast("int")
    less = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    edited = found.select(F.when(h % 199 == 0, less).otherwise(F.col("word")).alias("word"), "n").filter(F.length("word") >= 6)
    words = edited.groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 5")
    return permuterm.spelling_variants(words)


SEARCH_SQL = r"""
with terms as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from documents
), counted as (
    select doc_id, term, count(*)::bigint tf from terms group by all
), sizes as (
    select doc_id, sum(tf)::bigint n from counted group by doc_id
), corpus as (
    select count(*)::bigint documents, sum(n)::bigint total from sizes
), weights as (
    select term, floor(1000 * ln((2 * documents + 2)::double / (2 * df + 1)::double))::bigint w
    from (select term, count(*)::bigint df from counted group by term), corpus
), wanted as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark
), impacts as (
    select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // total))) impact
    from counted join sizes using (doc_id) join weights using (term), corpus
), scores as (
    select item_id, doc_id, sum(impact)::bigint score from wanted join impacts using (term) group by all
)
select item_id, rank, doc_id, score from (
    select *, row_number() over (partition by item_id order by score desc, doc_id)::int rank from scores where score > 0
) where rank <= 10
"""


@query("op13_shared_search", SEARCH_SQL)
def benchmark_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")
