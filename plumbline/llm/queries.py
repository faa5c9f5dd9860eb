"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import archives, bpe, html, langid, media, mixing, negatives, neighbours, quality, secrets, simhash, tokenfile, tries
from plumbline.llm.common import documents, tokenizer_file


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.stored(documents(spark, sf_dir)))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), "digests")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.scan(docs, secrets.trained(docs))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.written_and_read(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), end_id=2)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, sf_dir))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(documents(spark, sf_dir))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op11_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_bpe": op2_bpe,
    "op3_secrets": op3_secrets,
    "op4_token_file": op4_token_file,
    "op5_mixing": op5_mixing,
    "op6_neighbours": op6_neighbours,
    "op7_quality": op7_quality,
    "op8_langid": op8_langid,
    "op9_html": op9_html,
    "op10_simhash": op10_simhash,
    "op11_archives": op11_archives,
    "op12_trie": op12_trie,
    "op13_negatives": op13_negatives,
}

#: DuckDB text for what SQL can express; the other queries have brute-force tests.
ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op5_mixing"] = r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text,''), '[^\x20\x09-\x0D]+')) as bigint) size,
    cast(('0x'||substr(md5(coalesce(cast(doc_id as varchar),'')),1,15))::bigint as bigint) place from documents),
s as (select source, cast(sum(size) as bigint) source_size from d group by 1),
w as (select *, [5.0::double,2.0,1.0][(row_number() over (order by source nulls last)-1)%3+1] weight, source_size*3.0::double lim from s),
l as (select *, ((select sum(source_size) from w)-coalesce(sum(lim) over b,0)) / ((select sum(weight) from w)-coalesce(sum(weight) over b,0)) lev from w
    window b as (order by lim/weight, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, least(lim, (select max(lev) from l where lim>=lev*weight)*weight) target from l),
n as (select *, case when source_size>0 then cast(floor(target/source_size) as bigint) else 0 end times from t),
m as (select *, target-times*source_size need from n),
g as (select d.source, place, sum(size) words, any_value(need) need from d join m on d.source is not distinct from m.source group by 1,2),
c as (select *, sum(words) over (partition by source order by place) upto from g),
k as (select source, arg_min(place + case when words-(need-upto+words) < need-upto+words then 1 else 0 end, place) cut from c where need>0 and upto>=need group by 1)
select doc_id, size, source_size, target, cast(size*(times+case when place < coalesce(cut, case when need>0 then 1152921504606846976 else 0 end) then 1 else 0 end) as bigint) taken
from d join m on d.source is not distinct from m.source left join k on d.source is not distinct from k.source
"""

ORACLE_SQL["op11_archives"] = """
with d as (select page_id, octet_length(encode(coalesce(html,''))) payload_bytes, sha1(coalesce(html,'')) h from pages),
r as (select *, max(page_id) over (partition by h, payload_bytes) best from d)
select page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1+(((('0x'||substr(h, 1+5*(i//4), 5))::int >> (15-5*(i%4))::int) & 31)), 1)), '') payload_digest,
    case when page_id is not distinct from best then 'response' else 'revisit' end record_type,
    case when page_id is distinct from best then best end refers_to from r
"""

#: DuckDB has no crc32: its bits are folded over the decimal's bytes, -1 standing for the shift of one bit.
ORACLE_SQL["op12_trie"] = """
with t as (select conv_id, md5(length(coalesce(role,''))||':'||coalesce(role,'')||coalesce("text",'')) h, octet_length(encode(coalesce("text",''))) b, turn from conversations where conv_id is not null),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, h) pos from t),
c as (select conv_id, count(*) n, conv_id-conv_id%5 base, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint,-1,-1,-1,-1,-1,-1,-1,-1]))),
    lambda a, i: case when i>=0 then xor(a,i) else xor(a>>1, 3988292384*(a&1)) end))%9 k from t group by 1),
r as (select c.conv_id, pos depth, h, b from c join o on o.conv_id=c.base and pos<=k
    union all select c.conv_id, pos-c.k+least(c.k, coalesce(d.n,0)), h, b from c join o on o.conv_id=c.conv_id and pos>c.k left join c d on d.conv_id=c.base),
p as (select conv_id, depth, md5(string_agg(h, '') over (partition by conv_id order by depth rows unbounded preceding)) prefix, b from r union all select conv_id, 0, '', 0 from c),
n as (select depth, prefix, min(conv_id) conv_id, count(*) n_convs, any_value(b) b from p group by 1,2),
u as (select n.*, q.prefix above from n left join p q on q.conv_id=n.conv_id and q.depth=n.depth-1),
k as (select depth-1 depth, above prefix, count(*) n_children from u where depth>0 group by 1,2),
w as (select u.*, coalesce(n_children,0) n_children, (n_convs-1)*b saved from u left join k on k.depth=u.depth and k.prefix=u.prefix),
s as (select q.depth, q.prefix, sum((n_children=0)::int) n_leaves, sum(saved) saved_tokens from w join p q on q.conv_id=w.conv_id and q.depth<=w.depth group by 1,2),
e as (select depth, prefix, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) ends from p join (select conv_id i, max(depth) l from p group by 1) on i=conv_id and l=depth group by 1,2)
select w.conv_id, w.depth, m.conv_id parent_conv_id, w.n_convs, w.n_children, cast(n_leaves as bigint) n_leaves, cast(saved_tokens as bigint) saved_tokens, coalesce(ends, sha256('')) ends_sha256
from w join s on s.depth=w.depth and s.prefix=w.prefix left join e on e.depth=w.depth and e.prefix=w.prefix left join n m on m.depth=w.depth-1 and m.prefix=w.above
"""

ORACLE_SQL["op13_negatives"] = """
with v as (select vec_id, case when vec_id%7=0 then (label+1)%10 else label end l, list_transform(embedding, lambda x: floor(256.0::double*x::double)) p from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x)))=0),
s as (select a.vec_id anchor_id, v.vec_id, v.l=a.l same, cast(list_inner_product(a.p, v.p) as bigint) score from v a join v on a.vec_id%100=0 and v.vec_id<>a.vec_id),
p as (select anchor_id, vec_id positive_id, score positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as int) rank, vec_id negative_id, positive_score, score negative_score
from p join s on s.anchor_id=p.anchor_id and not same and 30*positive_score<=100*score and 100*score<=90*positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) <= 10
"""
