"""The operators of this folder, each run on its whole table, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.llm import (
    alignment,
    bitslice,
    decision_list,
    decontaminate,
    html_text,
    language,
    line_dedup,
    merkle,
    minhash,
    packing,
    sharding,
    toxicity,
    warc,
)
from wavebook.llm.common import table
from wavebook.session import new_folder

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SHARDS = 40


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_texts(table(spark, folder, "documents"), "doc_id", "text", tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        F.col("total_tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, folder, "documents"), least_equal=1)


def op3_content_addressed_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_folder(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), archive)
    return warc.read_archive(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = bitslice.quantised(table(spark, folder, "embeddings"), "vec_id", "embedding", 1024)
    return bitslice.top_k(vectors, vectors.where(F.col("id") % 100 == 0), 10)


def op5_layout_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages").select("page_id", "html")).select(
        "page_id", "text"
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = language.held_out("doc_id", 5, 0)
    machine = toxicity.fit(documents, table(spark, folder, "labels"), ~held_out)
    return toxicity.score(documents, machine).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    told = minhash.near_duplicates(table(spark, folder, "documents"), words=2, percent=80)
    return told.select("doc_id", "n_shingles", "component_id", "kept")


def op8_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = language.held_out("doc_id", 4, 2)
    network = language.fit(documents.where(~held_out).select("text", "lang"))
    told = language.identify(documents, network, ["doc_id"])
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_suffix_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op11_fragment_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ALIGNED]
    return alignment.align_texts(table(spark, folder, "documents"), "doc_id", "text", *paths)


def op12_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    rules = decision_list.fit(documents, table(spark, folder, "labels"))
    failed = decision_list.base_failed()
    verdict = rules.verdict(decision_list.features())
    return decision_list.statistics(documents, ["doc_id"]).select(
        "doc_id",
        *decision_list.BASE,
        failed.alias("base_failed"),
        (~failed & (verdict == 1)).alias("kept"),
    )


def op13_merkle_witnesses(spark: SparkSession, folder: str) -> DataFrame:
    """Only digests are carried on from the scan, those of the rows as they are and as tampered with."""
    told = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.digest_of([*told, F.col("text")])
    joined_lines = merkle.digest_of([*told, F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaves = table(spark, folder, "documents").select(
        "doc_id", "source", leaf.alias("leaf"), F.when(changed, joined_lines).otherwise(leaf).alias("tampered")
    )
    proved = merkle.witnessed(leaves, "source", ["doc_id"], "leaf")
    folded = proved.withColumn("folded_root", merkle.folded(F.col("tampered"), F.col("witness")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


REGISTRY = {
    "op1_vector_packing": op1_vector_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_content_addressed_warc": op3_content_addressed_warc,
    "op4_bit_sliced_top_k": op4_bit_sliced_top_k,
    "op5_layout_text": op5_layout_text,
    "op6_toxicity": op6_toxicity,
    "op7_circulant_minhash": op7_circulant_minhash,
    "op8_feistel_shards": op8_feistel_shards,
    "op9_language": op9_language,
    "op10_suffix_decontamination": op10_suffix_decontamination,
    "op11_fragment_alignment": op11_fragment_alignment,
    "op12_decision_list": op12_decision_list,
    "op13_merkle_witnesses": op13_merkle_witnesses,
}

ORACLE = {
    "op3_content_addressed_warc": """
        with facts as (
            select page_id, coalesce(html, '') as payload from pages
        ), digested as (
            select page_id, payload,
                   octet_length(encode(payload))::bigint as payload_bytes,
                   sha1(encode(payload)) as payload_digest
            from facts
        ), kept as (
            select *, max(page_id) over (partition by payload) as keeper,
                   count(*) over (partition by payload) as copies
            from digested
        ), typed as (
            select *, payload_bytes >= 1000 and copies > 1 and page_id <> keeper as again from kept
        )
        select page_id, payload_bytes, payload_digest,
               case when again then 'revisit' else 'response' end as record_type,
               case when again then keeper end as refers_to
        from typed
    """,
    "op4_bit_sliced_top_k": """
        with sound as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and vec_id is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
            from sound q join sound c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
        ), ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
    "op13_merkle_witnesses": """
        with recursive told as (
            select doc_id, source,
                   concat(coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-'),
                          coalesce(octet_length(encode(source)) || ':' || source, '-'),
                          coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                          coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-')) as head,
                   text, replace(text, chr(10), '') as flat
            from documents
        ), leaves as (
            select doc_id, source,
                   sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
                   sha256(head || coalesce(octet_length(encode(flat)) || ':' || flat, '-')) as joined_lines
            from told
        ), placed as (
            select *, row_number() over (order by source nulls first, doc_id nulls first, leaf) as nth,
                   row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
                   count(*) over (partition by source) as n,
                   dense_rank() over (order by source nulls first) - 1 as tree
            from leaves
        ), lower_nodes as (
            select tree, 0::bigint as level, pos, leaf as digest, n from placed
            union all
            select tree, level + 1, pos // 3, sha256(string_agg(digest, '' order by pos)), (n + 2) // 3
            from lower_nodes where n > 1 group by tree, level, pos // 3, n
        ), upper_nodes as (
            select 0::bigint as level, tree as pos, digest, count(*) over () as n from lower_nodes where n = 1
            union all
            select level + 1, pos // 3, sha256(string_agg(digest, '' order by pos)), (n + 2) // 3
            from upper_nodes where n > 1 group by level, pos // 3, n
        ), nodes as (
            select tree, level, pos, digest from lower_nodes where n > 1
            union all select -1, level, pos, digest from upper_nodes where n > 1
        ), steps as (
            select tree, level, pos,
                   coalesce(string_agg(digest, '') over (partition by tree, level, pos // 3 order by pos
                       rows between unbounded preceding and 1 preceding), '') as before,
                   coalesce(string_agg(digest, '') over (partition by tree, level, pos // 3 order by pos
                       rows between 1 following and unbounded following), '') as after
            from nodes
        ), ways as (
            select p.nth, s.level, s.before, s.after
            from placed p join steps s on s.tree = p.tree and s.pos = p.pos // (3 ** s.level)::bigint
            union all
            select p.nth, 1000 + s.level, s.before, s.after
            from placed p join steps s on s.tree = -1 and s.pos = p.tree // (3 ** s.level)::bigint
        ), numbered as (
            select *, row_number() over (partition by nth order by level) as step from ways
        ), sums as (
            select nth, xor(list_reduce(
                list_concat([4294967295::bigint],
                            list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                lambda crc, c: list_reduce(
                    [xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda x, y: xor(x >> 1, (x & 1) * 3988292384::bigint))), 4294967295::bigint) as crc
            from placed
        ), folds as (
            select nth, 0::bigint as step, case when crc % 2 = 0 then joined_lines else leaf end as digest
            from placed join sums using (nth)
            union all
            select f.nth, f.step + 1, sha256(w.before || f.digest || w.after)
            from folds f join numbered w on w.nth = f.nth and w.step = f.step + 1
        ), folded as (
            select nth, max_by(digest, step) as folded_root from folds group by nth
        ), proofs as (
            select nth, string_agg(before || after, '' order by step) as siblings from numbered group by nth
        )
        select doc_id, leaf, s.digest as subroot, r.digest as root,
               sha256(coalesce(siblings, '')) as proof_sha256, folded_root, folded_root = r.digest as verified
        from placed p join folded using (nth) left join proofs using (nth)
        join lower_nodes s on s.tree = p.tree and s.n = 1
        cross join (select digest from upper_nodes where n = 1) r
    """,
}
