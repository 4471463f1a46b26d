"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cargoweave.llm import (
    byte_bpe, decontamination, embedding_dedup, fingerprints, hard_negatives, line_dedup, minhash_dedup, mixing,
    periodic_runs, pii, quality, token_codes, toxicity,
)
from cargoweave.llm.common import small_batches, table
from cargoweave.sources.tables import new_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return byte_bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs))


def op6_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = new_path(spark, "token-codes")
    token_codes.write_codes(table(spark, sf_dir, "documents"), path, TOKENIZER, END_ID)
    return token_codes.read_codes(spark, path)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return line_dedup.without_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontamination.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_document_fingerprints, op3_byte_bpe, op4_embedding_near_dedup, op5_quality,
        op6_token_codes, op7_line_dedup, op8_source_mix, op9_personal_data, op10_toxicity,
        op11_benchmark_decontamination, op12_hard_negatives, op13_periodic_runs, pipeline,
    )
}

_COMPONENTS = """
    walk(node, other) as (
        select id, id from nodes union select w.node, e.b from walk w join links e on e.a = w.other
    ),
    components as (select node, min(other) as component_id from walk group by node)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": f"""
    with recursive words as (
        select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents
    ),
    sets as (
        select doc_id as id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end) as s from words
    ),
    sizes as (select id, count(*) as n from sets group by id),
    nodes as (select doc_id as id from words),
    pairs as (select x.id as a, y.id as b, count(*) as c from sets x join sets y on x.s = y.s and x.id < y.id group by all),
    half as (
        select a, b from pairs join sizes p on p.id = a join sizes q on q.id = b where 100 * c >= 75 * (p.n + q.n - c)
    ),
    links as (select a, b from half union all select b, a from half),
    {_COMPONENTS}
    select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
    from words left join sizes on id = doc_id join components on node = doc_id
    """,
    "op4_embedding_near_dedup": f"""
    with recursive fit as (
        select vec_id as id, label, embedding::double[] as v from embeddings
        where label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    nodes as (select vec_id as id from embeddings),
    half as (
        select x.id as a, y.id as b from fit x join fit y on x.label = y.label and x.id < y.id and len(x.v) = len(y.v)
        where list_cosine_similarity(x.v, y.v) >= 0.98
    ),
    links as (select a, b from half union all select b, a from half),
    {_COMPONENTS},
    counts as (select a, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
    from embeddings join components on node = vec_id left join counts on a = vec_id
    """,
    "op8_source_mix": """
    with recursive sized as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
            md5('mix:' || coalesce(doc_id::varchar, 'null')) as draw from documents
    ),
    totals as (select source, sum(size)::bigint as source_size from sized group by source),
    ranked as (
        select *, row_number() over (order by source nulls last) as place,
            [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
            2 * source_size as cap, sum(source_size) over () * 1.5::double as budget from totals
    ),
    leveled as (
        select *, cap / weight as full_at,
            coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0) as below,
            sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as shares
        from ranked
    ),
    level as (
        select arg_min((budget - below)::double / shares::double, (full_at, place)) as level from leveled
        where (budget - below)::double / shares::double <= full_at
    ),
    aims as (
        select source, source_size, target, whole, target - whole * source_size as room from (
            select *, case when source_size > 0 then floor(target / source_size)::int else 0 end as whole from (
                select source, source_size,
                    case when level is null or full_at <= level then cap::double else level * weight end as target
                from leveled, level))
    ),
    units as (select source, draw, sum(size)::bigint as size from sized group by source, draw),
    summed as (
        select u.*, sum(u.size) over (partition by u.source order by draw rows unbounded preceding) as upto
        from units u join aims a on a.source is not distinct from u.source where u.size <= room
    ),
    prefix as (
        select a.*, coalesce(max(draw) filter (where upto <= room), '') as last,
            room - coalesce(max(upto) filter (where upto <= room), 0) as rest
        from aims a left join summed s on s.source is not distinct from a.source
        group by a.source, a.source_size, a.target, a.whole, a.room
    ),
    fill as (
        select source, last, rest, null::bigint as bsize, null::varchar as bdraw from prefix
        union all
        select source, last, rest - best.s, best.s, best.d from (
            select f.source, f.last, f.rest, max({'s': u.size, 'd': u.draw}) as best
            from fill f join units u on u.source is not distinct from f.source
            where u.size > 0 and u.size <= f.rest and u.draw > f.last
              and (f.bsize is null or u.size < f.bsize or (u.size = f.bsize and u.draw < f.bdraw))
            group by f.source, f.last, f.rest)
    )
    select doc_id, size, p.source_size, p.target, (size * (p.whole + case
        when p.whole < 2 and ((d.draw <= p.last and size <= room) or f.bdraw is not null) then 1 else 0 end
    ))::bigint as taken
    from sized d join prefix p on p.source is not distinct from d.source
    left join fill f on f.source is not distinct from d.source and f.bdraw = d.draw
    """,
    "op11_benchmark_decontamination": """
    with item_words as (
        select row_number() over () as r, item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w
        from benchmark
    ),
    windows as (
        select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as phrase
        from item_words, unnest(range(1, greatest(1, len(w) - 9) + 1)) as t(i) where len(w) > 0
    ),
    document_words as (
        select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w
        from documents
    ),
    places as (
        select r, i, n, array_to_string(w[i:i + n - 1], ' ') as phrase
        from document_words, (select distinct n from windows), unnest(range(1, len(w) - n + 2)) as t(i)
    ),
    found as (select r, i, p.n, item_id from places p join windows v on v.n = p.n and v.phrase = p.phrase),
    hit as (select r, count(distinct k) as n_hit from found, unnest(range(i, i + n)) as t(k) group by r),
    items as (select distinct r, item_id::varchar as item from found where item_id is not null),
    named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names from items group by r)
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(names, '')) as items_sha256, n_hit is not null as contaminated
    from document_words left join hit using (r) left join named using (r)
    """,
    "op12_hard_negatives": """
    with whole as (
        select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(x::double * 256)) as v
        from embeddings where label is not null and embedding is not null and len(embedding) > 0
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    scored as (
        select a.id as anchor, b.id as other, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
        from whole a join whole b on a.id <> b.id and len(a.v) = len(b.v) where a.id % 100 = 0
    ),
    positives as (
        select anchor, other, score from scored where same
        qualify row_number() over (partition by anchor order by score desc, other) <= 5
    )
    select p.anchor as anchor_id, p.other as positive_id,
        (row_number() over (partition by p.anchor, p.other order by n.score desc, n.other))::int as rank,
        n.other as negative_id, p.score as positive_score, n.score as negative_score
    from positives p join scored n on n.anchor = p.anchor and not n.same
        and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
    qualify rank <= 10
    """,
    "op13_periodic_runs": """
    with bytes as (
        select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
            case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as crcs
    ),
    plain as (
        select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                lambda x: x <> '') as w,
            xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
                lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
        from documents, bytes
    ),
    placed as (select *, len(w) as n, (h // 10) % len(w) as a from plain),
    changed as (
        select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i:
            case when i < a then w[i + 1] else w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] end) else w end as w
        from placed
    ),
    places as (select r, n, generate_subscripts(w, 1) - 1 as i, unnest(w) as word from changed),
    equal as (
        select x.r, y.i - x.i as q, x.i from places x join places y on x.r = y.r and x.word = y.word and y.i > x.i
        where (y.i - x.i) * 4 <= x.n
    ),
    grouped as (select r, q, i, i - row_number() over (partition by r, q order by i) as g from equal),
    stretches as (
        select r, min(i) as start, count(*) + q as length, q from grouped group by r, q, g
        having count(*) + q >= greatest(6, 4 * q)
    ),
    runs as (select r, start, length, min(q) as q from stretches group by r, start, length),
    listed as (
        select r, count(*) as n_runs, arg_min((start, length, q), (-length, start, q)) as best,
            string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) as lines
        from runs group by r
    ),
    dropped as (select distinct r, i from runs, unnest(range(start + q, start + length)) as t(i)),
    kept as (
        select r, string_agg(word, ' ' order by i) as text from places p
        where not exists (select 1 from dropped d where d.r = p.r and d.i = p.i) group by r
    )
    select doc_id, coalesce(n_runs, 0) as n_runs, best[1] as start, best[2] as length, best[3] as period,
        1000 * best[2] // best[3] as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
        sha256(coalesce(text, '')) as collapsed_sha256
    from changed left join listed using (r) left join kept using (r)
    """,
}
