"""The registered queries: each applies one operator to its whole table."""


import public_tokenizers
from pyspark.sql import functions as F

from starloom.llm import (
    bpe,
    hamming,
    html_text,
    jaccard,
    lattice,
    lexical,
    outliers,
    packing,
    prefix_trie,
    preference,
    quality,
    query,
    substrings,
    warc,
)
from starloom.session import read_table, work_folder


def _held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


@query()
def op1_quality_classifier(spark, d):
    """Quality score of every document; learns from rows that are not held out."""
    documents = read_table(spark, d, "documents").select("doc_id", "text")
    labels = read_table(spark, d, "labels").where(~_held_out(F.col("doc_id")))
    model = quality.train(documents, labels)
    scored = documents.withColumn("score", quality.quality_score(F.col("text"), model))
    return scored.select(
        "doc_id",
        _held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op7_quality_rules(spark, d):
    """Counts, base rules and outlier verdict of every document."""
    return outliers.quality_rules(read_table(spark, d, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "distance",
    )


@query()
def op3_substring_dedup(spark, d):
    """Words of every document that are left without repeated 35-word windows."""
    return substrings.substring_digests(read_table(spark, d, "documents"))


@query()
def op9_ngram_jaccard(spark, d):
    """Number of shingles and near-duplicate class of every document."""
    return jaccard.near_classes(read_table(spark, d, "documents"))


@query()
def op4_packing(spark, d):
    """Length bucket and batch of every piece of every document."""
    return packing.pack(read_table(spark, d, "documents"), packing.word_tokens(F.col("text")))


_CODE = "list_sum([case when embedding[i] >= 0 then 1::bigint << (i - {0}) else 0 end for i in range({0}, {1})])"


@query(f"""
with codes as (
    select vec_id, {_CODE.format(1, 33)} as low, {_CODE.format(33, 65)} as high from embeddings
    where vec_id is not null and embedding is not null
), met as (
    select q.vec_id as query_id, r.vec_id as vec_id,
        (bit_count(xor(q.low, r.low)::bigint) + bit_count(xor(q.high, r.high)::bigint))::integer as distance
    from codes q, codes r where q.vec_id % 20 = 0
)
select query_id, vec_id, distance, rank::integer as rank
from (select *, row_number() over (partition by query_id order by distance, vec_id) as rank from met) where rank <= 10""")
def op2_exact_topk(spark, d):
    """The ten nearest sign codes of every vector whose id is divisible by 20, among all vectors."""
    vectors = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = hamming.nearest_codes(vectors, vectors.where("id % 20 = 0"))
    return found.select("query_id", F.col("id").alias("vec_id"), "distance", "rank")


_TURN = "'<|im_start|>' || t.role || chr(10)"
_MASK = """case when t.role = 'assistant'
    then length({0}) || ':0,' || (length(t.text) + 11) || ':1' else (length({0}) + length(t.text) + 11) || ':0' end""".format(_TURN)


@query(f"""
with clean as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), lists as (
    select conv_id, list({{'turn': turn, 'role': role, 'text': text}} order by turn nulls first, role, text) as turns,
        sum(case when role = 'assistant' then length(text) else 0 end) as said
    from clean group by conv_id
), ranked as (
    select *, row_number() over (partition by conv_id // 2 order by said desc, conv_id) as place from lists
), pairs as (
    select a.conv_id as chosen_id, b.conv_id as rejected_id, a.turns as one, b.turns as other
    from ranked a join ranked b on a.conv_id // 2 = b.conv_id // 2 and a.place = 1 and b.place = 2
), split as (
    select *, coalesce(list_min([i for i in range(1, greatest(len(one), len(other)) + 1)
        if one[i] is null or other[i] is null or one[i].role <> other[i].role or one[i].text <> other[i].text]) - 1,
        len(one))::integer as n_common
    from pairs
)
select chosen_id, rejected_id, n_common,
    array_to_string([{_TURN} || t.text || '<|im_end|>' || chr(10) for t in one[1:n_common]], '') as prompt,
    array_to_string([{_TURN} || t.text || '<|im_end|>' || chr(10) for t in one[n_common + 1:]], '') as chosen,
    array_to_string([{_TURN} || t.text || '<|im_end|>' || chr(10) for t in other[n_common + 1:]], '') as rejected,
    array_to_string([{_MASK} for t in one[n_common + 1:]], ',') as chosen_mask,
    array_to_string([{_MASK} for t in other[n_common + 1:]], ',') as rejected_mask
from split""")
def op8_chat_formatting(spark, d):
    """Preference examples of the conversations 2i and 2i + 1."""
    conversations = read_table(spark, d, "conversations")
    return preference.preference_examples(conversations, preference.neighbour_pairs(conversations))


@query()
def op5_bpe(spark, d, path=None):
    """Tokens of every document and the text they decode to, as digests."""
    source = bpe.load(spark, path or public_tokenizers.path("word_bpe_49k.json"))
    documents = read_table(spark, d, "documents")
    return documents.select("doc_id", bpe.digest_column(F.col("text"), source).alias("made")).select("doc_id", "made.*")


@query("""
with rows as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), firsts as (
    select payload_digest, min(page_id) as first from rows where payload_bytes >= 100 group by payload_digest
)
select page_id, payload_bytes, payload_digest,
    case when first is null or first is not distinct from page_id then 'response' else 'revisit' end as record_type,
    case when first is not distinct from page_id then null else first end as refers_to
from rows left join firsts using (payload_digest)""")
def op6_warc(spark, d):
    """The records of all pages, written as archives and read back."""
    folder = work_folder(spark, "warc")
    warc.write_archives(read_table(spark, d, "pages"), folder)
    pages = warc.pages_of(warc.read_archives(spark, folder))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op10_html_text(spark, d):
    """Visible text of every page."""
    return read_table(spark, d, "pages").select("page_id", html_text.visible_text(F.col("html")).alias("text"))


@query("""
with own as (
    select conv_id as conv, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
        partition by conv_id order by turn nulls first, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
    ) as pos from conversations where conv_id is not null
), poly as (
    select n, list_reduce(range(0, 9), lambda c, i: case when i = 0 then c when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n) as v
    from range(0, 256) t(n)
), tables as (select list(v order by n) as crcs from poly
), convs as (
    select conv, count(*) as own, conv - conv % 100 as base, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, length(conv::varchar) + 1), lambda i: ascii(substr(conv::varchar, i, 1))::bigint)),
        lambda c, b: xor(c >> 8, any_value(crcs)[(xor(c, b) & 255) + 1])
    ), 4294967295) % 6 as h
    from own, tables group by conv
), turns as (
    select c.conv, o.pos as depth, o.role, o.text from convs c join own o on o.conv = c.base and o.pos <= c.h
    union all
    select c.conv, o.pos - c.h + least(c.h, coalesce(b.own, 0)), o.role, o.text
    from convs c join own o on o.conv = c.conv and o.pos > c.h left join convs b on b.conv = c.base
), paths as (
    select conv, depth, length(text) as chars,
        md5(string_agg(length(role) || ':' || length(text) || ':' || role || text, '' order by depth) over (
            partition by conv order by depth rows between unbounded preceding and current row)) as node
    from turns
    union all select conv, 0, 0, '' from convs
), nodes as (
    select node, any_value(depth) as depth, min(conv) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved
    from paths group by node
), ends as (
    select node, sha256(string_agg(conv::varchar, ',' order by conv)) as ends_sha256
    from (select conv, arg_max(node, depth) as node from paths group by conv) group by node
), parents as (
    select distinct a.node, b.node as parent from paths a join paths b on a.conv = b.conv and a.depth = b.depth + 1
), under as (
    select distinct a.node as top, b.node from paths a join paths b on a.conv = b.conv and a.depth <= b.depth
), children as (select parent, count(*) as n from parents group by parent
), sums as (
    select top, sum(saved) as saved, count(*) filter (where c.n is null) as leaves
    from under join nodes using (node) left join children c on c.parent = under.node group by top
)
select n.conv_id::bigint as conv_id, n.depth::bigint as depth, p.conv_id::bigint as parent_conv_id, n.n_convs::bigint as n_convs,
    coalesce(c.n, 0)::bigint as n_children, s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens,
    coalesce(ends_sha256, sha256('')) as ends_sha256
from nodes n join sums s on s.top = n.node left join children c on c.parent = n.node left join parents on parents.node = n.node
    left join nodes p on p.node = parents.parent left join ends on ends.node = n.node""")
def op11_prefix_trie(spark, d):
    """The trie of all conversations, each rebuilt on the first turns of its hundred's conversation."""
    turns = prefix_trie.ordered_turns(read_table(spark, d, "conversations"))
    shared = F.crc32(F.col("conv").cast("string")) % 6
    return prefix_trie.prefix_trie(*prefix_trie.share_openings(turns, F.col("conv") - F.col("conv") % 100, shared, 5))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term"""


@query(f"""
with words as (select doc_id, {_TERMS} from documents
), held as (select doc_id, term, count(*) as tf from words group by 1, 2
), sizes as (select doc_id, count(*) as n from words group by 1
), whole as (select count(*) as docs, sum(n)::bigint as total from sizes
), weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from held, whole group by term, docs
), asked as (select item_id, term, count(*) as times from (select item_id, {_TERMS} from benchmark) group by 1, 2
), scores as (
    select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::bigint as score
    from asked join held using (term) join weights using (term) join sizes using (doc_id), whole group by 1, 2
)
select item_id, rank::integer as rank, doc_id, score from (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0
) where rank <= 20""")
def op12_lexical_search(spark, d):
    """The twenty best documents for every benchmark item."""
    items = read_table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = lexical.best_documents(read_table(spark, d, "documents"), items)
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


@query("""
with recursive units as (
    select vec_id, embedding, list_sum(list_transform(embedding, lambda x: x::double * x::double)) as square from embeddings
    where embedding is not null
), links as (
    select a.vec_id as a, b.vec_id as b from units a join units b on a.vec_id <> b.vec_id and len(a.embedding) = len(b.embedding)
    where list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(a.square * b.square) >= 0.95
), reach as (
    select vec_id, vec_id as other from embeddings
    union select reach.vec_id, links.b from reach join links on links.a = reach.other
)
select vec_id, (select count(*) from links where a = vec_id)::bigint as n_links, min(other) as component_id, vec_id = min(other) as kept
from reach group by vec_id""")
def op13_lattice_dedup(spark, d):
    """Number of links and near-duplicate class of every vector."""
    return lattice.near_vectors(read_table(spark, d, "embeddings"))
