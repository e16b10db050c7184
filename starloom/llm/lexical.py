"""Ranked lexical search by the Best Position Algorithm.

The documents are tokenised once; of each only the terms that some query asks
for are kept, with their counts. A task takes the documents as they come, in
blocks of a bounded number of entries. A block has one impact list per term: its
documents by falling impact (what the term adds to a score). For a query the
lists of its terms are read side by side, a run of positions at a time. Every
document that is read is scored at once by direct accesses to all lists, and each
access marks its position as seen, in whichever list. The best position of a list
is the last one up to which all positions have been seen; it lies at or beyond
the last one read. A document that has not been seen lies behind the best
position of every list, so it scores at most the sum of the impacts there: the
search of a block ends as soon as that sum is strictly below the k-th score.
(An equal score could still win by its smaller id.) The k best of a task's
earlier blocks count as well, so later blocks end sooner, and only the best of
each task are merged.

The queries are taken in sets of about ``QUERY_ENTRIES`` terms, by hash; every
set meets all documents. Scores are integers and exact; positions and thresholds
only decide what need not be read.

Defined results: terms are case-folded for A to Z only; documents that are null
or without terms have no part in any count; a document with a null id counts in
all statistics and ranks behind equal scores with an id; equal ids or repeated
rows are separate documents; a query without terms, or whose terms occur nowhere,
has no rows; a repeated query (same id and text) counts once, one id with two
texts ranks each text by itself. Extra columns are not read.
"""

import heapq
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.words import slices
from starloom.session import work_folder

#: Distinct terms over all queries of a set, about: 16 bytes and a word each on the driver and in a task.
QUERY_ENTRIES = 200_000
#: Entries (a document's distinct query terms) in a block.
BLOCK_ENTRIES = 2_000_000
#: Positions of each list that are read at a time, at first and at most.
_RUN, _LONGEST_RUN = 32, 4_096

#: Bytes outside terms become spaces, A to Z lower case; bytes of longer code points stay.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text):
    """UTF-8 terms of a text: the maximal runs of ASCII letters, digits and other code points; none for a null."""
    return [] if text is None else text.encode("utf-8").translate(_FOLD).split()


def weight(n_documents, holding):
    """Weight of a term that ``holding`` of ``n_documents`` documents hold."""
    return floor(1000 * log((2 * n_documents + 2) / (2 * holding + 1)))


def _query_terms(batches):
    for batch in batches:
        ids, names, counts = [], [], []
        for query, text in zip(batch.column("query").to_pylist(), batch.column("text").to_pylist()):
            for term, count in Counter(terms(text)).items():
                ids.append(query)
                names.append(term)
                counts.append(count)
        columns = [pa.array(ids, pa.string()), pa.array(names, pa.binary()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "term", "count"])


def _forward(number):
    """Documents -> id, number of terms, the numbers and counts of those terms that queries ask for."""

    def forward(batches):
        for batch in slices(batches):
            ids, sizes, found, counts = [], [], [], []
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                words = terms(text.as_py())
                if words:
                    known = sorted((number[w], c) for w, c in Counter(words).items() if w in number)
                    ids.append(doc.as_py())
                    sizes.append(len(words))
                    found.append([t for t, _ in known])
                    counts.append([c for _, c in known])
            kinds = pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())
            columns = [pa.array(c, kind) for c, kind in zip((ids, sizes, found, counts), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return forward


def impacts(weights, counts, sizes, n_documents, n_terms):
    """What a term adds to a document's score, in 64-bit integers."""
    m = 75 + (25 * sizes * n_documents) // n_terms
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 12 * m))


class ImpactLists:
    """The documents of a block by term: in order of documents for direct access, and by falling impact."""

    def __init__(self, documents, owner, term, impact):
        """The number of documents and their entries ``owner`` (the document), ``term``, ``impact``."""
        self.documents = documents
        by_term = np.lexsort((owner, term))
        self.owner, self.impact = owner[by_term], impact[by_term]
        self.terms, self.first = np.unique(term[by_term], return_index=True)
        self.end = np.append(self.first[1:], len(term))
        falling = np.lexsort((self.owner, -self.impact, term[by_term]))
        #: Entry at each position of the impact lists, and position of each entry, both counted over all lists.
        self.at, self.position = falling, np.empty_like(falling)
        self.position[falling] = np.arange(len(falling))

    def lists(self, asked):
        """``(first, end, times)`` of the lists of the terms asked for."""
        place = np.searchsorted(self.terms, asked[0])
        inside = place < len(self.terms)
        there = np.zeros(len(place), bool)
        there[inside] = self.terms[place[inside]] == asked[0][inside]
        return [(int(self.first[p]), int(self.end[p]), int(t)) for p, t in zip(place[there], asked[1][there])]

    def search(self, asked, k, least):
        """Documents that may be among the ``k`` best, with their scores, and the number of positions read.

        ``least`` is the k-th score known so far (0: none).
        """
        lists = self.lists(asked)
        seen = [np.zeros(end - first, bool) for first, end, _ in lists]
        best = [0] * len(lists)
        scored = np.zeros(self.documents, bool)
        documents, scores, kth, depth, run, read = [], [], least, 0, _RUN, 0
        while lists:
            # Read the next run of every list.
            new = []
            for (first, end, _), mark in zip(lists, seen):
                upto = min(end, first + depth + run)
                if first + depth < upto:
                    new.append(self.owner[self.at[first + depth : upto]])
                    mark[depth : upto - first] = True
                    read += upto - first - depth
            depth, run = depth + run, min(2 * run, _LONGEST_RUN)
            if not new:
                break
            new = np.concatenate(new)
            new = np.unique(new[~scored[new]])
            if len(new):
                # Direct accesses: every new document in every list.
                total = np.zeros(len(new), np.int64)
                for (first, end, times), mark in zip(lists, seen):
                    place = first + np.searchsorted(self.owner[first:end], new)
                    here = place < end
                    here[here] = self.owner[place[here]] == new[here]
                    total[here] += times * self.impact[place[here]]
                    mark[self.position[place[here]] - first] = True
                scored[new] = True
                keep = (total >= kth) & (total > 0)
                documents.append(new[keep])
                scores.append(total[keep])
                known = np.concatenate(scores)
                if len(known) >= k:
                    kth = max(kth, int(np.partition(known, len(known) - k)[len(known) - k]))
            # Best positions, and the most that a document behind all of them can score.
            most = 0
            for i, ((first, _, times), mark) in enumerate(zip(lists, seen)):
                rest = mark[best[i] :]
                best[i] = len(mark) if rest.all() else best[i] + int(np.argmin(rest))
                if best[i] < len(mark):
                    most += times * int(self.impact[self.at[first + best[i] - 1]])
            if most == 0 or most < kth:
                break
        if not documents:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), read
        return np.concatenate(documents), np.concatenate(scores), read


def _rank(queries, weights, n_documents, n_terms, k, block_entries):
    """Forward rows -> the best of the task for each query."""

    def rank(batches):
        top = [[] for _ in queries]  # heaps of (score, -id or lowest without one), the worst first
        none = -(2**63)

        def search(rows):
            ids = [i for r in rows for i in r[0]]
            sizes, lengths, term, counts = (np.concatenate([r[c] for r in rows]) for c in range(1, 5))
            owner = np.repeat(np.arange(len(ids)), lengths)
            added = impacts(weights[term], counts, sizes[owner], n_documents, n_terms)
            block = ImpactLists(len(ids), owner, term, added)
            for heap, asked in zip(top, queries):
                documents, scores, _ = block.search(asked, k, heap[0][0] if len(heap) == k else 0)
                for document, score in zip(documents.tolist(), scores.tolist()):
                    name = ids[document]
                    entry = (score, none if name is None else -name)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)

        rows, entries = [], 0
        for batch in slices(batches):
            found, counts = batch.column("terms"), batch.column("counts")
            term = found.flatten().to_numpy()
            sizes, lengths = batch.column("n").to_numpy(), np.diff(found.offsets.to_numpy())
            rows.append((batch.column("doc_id").to_pylist(), sizes, lengths, term, counts.flatten().to_numpy()))
            entries += len(term)
            if entries >= block_entries:
                search(rows)
                rows, entries = [], 0
        if entries:
            search(rows)
        found = [(q, None if d == none else -d, s) for q, heap in enumerate(top) for s, d in heap]
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return rank


def best_documents(
    documents: DataFrame, queries: DataFrame, k=20, query_entries=QUERY_ENTRIES, block_entries=BLOCK_ENTRIES
) -> DataFrame:
    """``query_id, rank, doc_id, score`` of the ``k`` best documents (``doc_id, text``) for each query (``query_id, text``)."""
    spark = documents.sparkSession
    folder = work_folder(spark, "lexical")
    named = queries.select("query_id", "text").where("text is not null").distinct()
    name = F.sha2(F.concat_ws("/", F.coalesce(F.col("query_id").cast("string"), F.lit("none")), "text"), 256)
    named.withColumn("query", name).write.parquet(f"{folder}/queries")
    named = spark.read.parquet(f"{folder}/queries")
    named.select("query", "text").mapInArrow(_query_terms, "query string, term binary, count bigint").write.parquet(
        f"{folder}/query_terms"
    )
    asked = spark.read.parquet(f"{folder}/query_terms")
    sets = max(1, -(-asked.count() // query_entries))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = []
    for s in range(sets):
        entries = asked.where(F.pmod(F.xxhash64("query"), F.lit(sets)) == s)
        parts.append(_ranked(texts, entries, f"{folder}/{s}", k, block_entries))
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionByName(part)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    kept = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return kept.join(named.select("query", "query_id"), "query").select("query_id", "rank", "doc_id", "score")


def _ranked(texts, entries, folder, k, block_entries):
    """The best of every task for one set of queries: ``query, doc_id, score``."""
    spark = texts.sparkSession
    rows = entries.orderBy("query", "term").collect()  # Bounded by the size of a set.
    number = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in rows}))}
    names = list(dict.fromkeys(r.query for r in rows))
    forward = texts.mapInArrow(_forward(number), "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")
    forward.write.parquet(f"{folder}/forward")
    forward = spark.read.parquet(f"{folder}/forward")
    n_documents, n_terms = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # One row per term of the set.
    weights = np.zeros(len(number), np.int64)
    for r in held:
        weights[r.term] = weight(n_documents, r["count"])
    queries = {name: [] for name in names}
    for r in rows:
        queries[r.query].append((number[bytes(r.term)], r["count"]))
    asked = [tuple(np.array(c, np.int64) for c in zip(*sorted(queries[name]))) for name in names]
    found = forward.select("doc_id", "n", "terms", "counts").mapInArrow(
        _rank(asked, weights, n_documents, n_terms, k, block_entries), "number int, doc_id bigint, score bigint"
    )
    ids = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "number int, query string")
    return found.join(ids, "number").select("query", "doc_id", "score")
