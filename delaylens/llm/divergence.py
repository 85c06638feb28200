"""Divergence of sources from each other and from their language, by count cells.

``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))`` is a smoothed share of a term in a group (a language
and a source), ``q`` that of another source or of the language, and ``f = floor((p - q)^2 / (p + q))``
their divergence. Terms with equal counts have equal values, so terms are grouped by their cell
(count here, count there), f is evaluated once a cell, and the number of terms in a cell stands
for them: sums over all terms need no term, and the first ranks are found on the cells alone
(running multiplicity over falling values, equal values merged) before only their terms are read.

Terms of a pair of sources that are in neither, or in one alone, follow from how many terms each source
has with each count; only terms in both are looked at together, in tasks that hold a stretch of
terms as a matrix and give out cells. Rows of the result are a square of the number of sources of a
language, as every pair is asked for; nothing else is.

Null texts, languages and sources are ''. Documents are counted as rows: repeated rows count again, and
doc_id is not used. Extra columns are not carried. A language without kept terms has pairs of
value 0 and no term rows; an empty table gives an empty table. Counts may reach 9e9 in a language:
shares are computed as decimals of 38 digits.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from delaylens.llm.common import stored
from delaylens.llm.kernels import slices, texts_of

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
#: Text whose terms are counted before they leave the task.
COUNT_BYTES = 8_000_000
#: Entries of the matrix of a stretch of terms.
MATRIX_ENTRIES = 2_000_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
_LETTER[128:] = True


def terms_of(column):
    """(terms, row of each): runs of letters and characters beyond ASCII, A-Z in lower case."""
    texts = texts_of(column)
    data = np.where(_LETTER[texts.data], texts.data, 32).astype(np.uint8)
    plain = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(texts.offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
    split = pc.ascii_split_whitespace(pc.ascii_lower(plain))
    terms, rows = split.flatten(), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(full), rows.filter(full).to_numpy()


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences, and rows that have the term, for every group."""
    def run(batches):
        for piece in slices(batches, "text", COUNT_BYTES):
            terms, rows = terms_of(piece.column(2))
            if not len(terms):
                continue
            groups = pa.table({"lang": piece.column(0), "source": piece.column(1)})
            names = groups.group_by(["lang", "source"]).aggregate([])
            names = names.append_column("g", pa.array(np.arange(names.num_rows)))
            # group number of every row of the piece, in its order
            at = groups.append_column("row", pa.array(np.arange(groups.num_rows))).join(
                names, ["lang", "source"]).sort_by("row")["g"].to_numpy()
            coded = terms.dictionary_encode()
            size = len(coded.dictionary)
            term = coded.indices.to_numpy().astype(np.int64)
            keys, n = np.unique(at[rows] * size + term, return_counts=True)
            once = np.unique(rows * size + term)
            d = np.bincount(np.searchsorted(keys, at[once // size] * size + once % size),
                            minlength=len(keys))
            of = pa.array(keys // size)
            yield pa.RecordBatch.from_arrays(
                [names["lang"].combine_chunks().take(of), names["source"].combine_chunks().take(of),
                 coded.dictionary.take(pa.array(keys % size)).cast(pa.string()), pa.array(n),
                 pa.array(d)], names=["lang", "source", "term", "n", "d"])

    parts = docs.mapInArrow(run, "lang string, source string, term string, n long, d long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def share(count, total, terms):
    """Exact ``1 + floor(SCALE * (count + 2) / (total + 2 terms))``."""
    up = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function(
        "div", up, (total + 2 * terms).cast("decimal(20,0)")).cast("long")


def divergence(p, q):
    return F.call_function("div", (p - q) * (p - q), p + q)


def shared_cells(vectors: DataFrame) -> DataFrame:
    """(lang, a, b, na, nb, m): number of terms that sources a < b have na and nb times, both above 0.

    ``vectors`` has one row per term: lang, sources (sorted) and their counts.
    """
    def cells(lang, sources, counts):
        names = sorted({s for row in sources for s in row})
        at = {s: k for k, s in enumerate(names)}
        step = max(1, MATRIX_ENTRIES // len(names))
        for low in range(0, len(sources), step):
            grid = np.zeros((min(step, len(sources) - low), len(names)), np.int64)
            for k, (who, n) in enumerate(zip(sources[low:low + step], counts[low:low + step])):
                grid[k, [at[s] for s in who]] = n
            for a in range(len(names)):
                rows = grid[grid[:, a] > 0]
                for b in range(a + 1, len(names)):
                    both = rows[rows[:, b] > 0][:, [a, b]]
                    if not len(both):
                        continue
                    both = both[np.lexsort([both[:, 1], both[:, 0]])]
                    first = np.flatnonzero(np.append(True, (both[1:] != both[:-1]).any(1)))
                    found, m = both[first], np.diff(np.append(first, len(both)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(m)), pa.array([names[a]] * len(m)),
                         pa.array([names[b]] * len(m)), pa.array(found[:, 0]),
                         pa.array(found[:, 1]), pa.array(m)],
                        names=["lang", "a", "b", "na", "nb", "m"])

    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            for lang in sorted(set(rows["lang"])):
                own = [k for k, x in enumerate(rows["lang"]) if x == lang]
                yield from cells(lang, [rows["sources"][k] for k in own],
                                 [rows["counts"][k] for k in own])

    parts = vectors.mapInArrow(run, "lang string, a string, b string, na long, nb long, m long")
    return parts.groupBy("lang", "a", "b", "na", "nb").agg(F.sum("m").alias("m"))


def audit(docs: DataFrame, text="text", lang="lang", source="source", min_docs=MIN_DOCS,
          top=TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: see the module. Parts are ``pair`` and ``term``."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = stored(counted(plain), "divergence-terms")
    kept = (counts.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("n_lang"))
            .where(F.col("d") >= min_docs).drop("d"))
    terms = stored(counts.drop("d").join(kept, ["lang", "term"]), "divergence-kept")
    langs = plain.select("lang").distinct().join(
        stored(kept, "divergence-langs").groupBy("lang").agg(
            F.count("term").alias("v"), F.sum("n_lang").alias("total_lang")), "lang", "left"
    ).fillna(0, ["v", "total_lang"])
    groups = stored(plain.select("lang", "source").distinct().join(
        terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("term").alias("own")),
        ["lang", "source"], "left").fillna(0, ["total", "own"]).join(langs, "lang"),
        "divergence-groups")
    return pairs(terms, groups).unionByName(leading_terms(terms, groups, top))


def pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language with the divergence summed over all kept terms."""
    none = F.lit(0).cast("long")
    # cells of one source against absence: how many of its terms have each count
    single = terms.groupBy("lang", "source", "n").agg(F.count("term").alias("m"))
    vectors = terms.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("x")).select(
        "lang", F.col("x.source").alias("sources"), F.col("x.n").alias("counts"))
    both = shared_cells(vectors.where(F.size("sources") > 1))

    def side(name):
        return groups.select("lang", F.col("source").alias(name), F.col("total").alias(f"t{name}"),
                             F.col("own").alias(f"o{name}"), *(["v"] if name == "a" else []))

    every = side("a").join(side("b"), "lang").where("a < b")

    def p(count, name):
        return share(count, F.col(f"t{name}"), F.col("v"))

    def f(na, nb):
        return divergence(p(na, "a"), p(nb, "b"))

    na, nb, m = F.col("na"), F.col("nb"), F.col("m")
    # a term in both was counted with each source alone: that is taken back, once the other is added
    joint = both.join(every, ["lang", "a", "b"]).select(
        "lang", "a", "b", (m * (f(na, nb) - f(na, none) - f(none, nb) + f(none, none))).alias("x"))
    alone = [single.select("lang", F.col("source").alias(name), F.col("n").alias(f"n{name}"), "m")
             .join(every, ["lang", name]).select("lang", "a", "b", (m * (
                 (f(na, none) if name == "a" else f(none, nb)) - f(none, none))).alias("x"))
             for name in "ab"]
    empty = every.select("lang", "a", "b", F.when(F.col("v") > 0, F.col("v") * f(none, none))
                         .otherwise(none).alias("x"))
    value = (joint.unionByName(alone[0]).unionByName(alone[1]).unionByName(empty)
             .groupBy("lang", "a", "b").agg(F.sum("x").alias("value")))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                              F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return value.select("lang", "value", sides.alias("s")).select(
        "lang", "s.source", F.lit("pair").alias("part"), "s.item", "value").withColumn("rank", rank)


def leading_terms(terms: DataFrame, groups: DataFrame, top=TOP) -> DataFrame:
    """Terms that a group has more than its language, by value, to rank ``top``."""
    group = ["lang", "source"]
    p = share(F.col("n"), F.col("total"), F.col("v"))
    q = share(F.col("n_lang"), F.col("total_lang"), F.col("v"))
    cells = (terms.groupBy(*group, "n", "n_lang").agg(F.count("term").alias("m"))
             .join(groups, group).where(p > q)
             .select(*group, "n", "n_lang", "m", divergence(p, q).alias("value")))
    falling = W.partitionBy(*group).orderBy(F.desc("value"))
    values = cells.groupBy(*group, "value").agg(F.sum("m").alias("m"))
    leading = values.withColumn("k", F.row_number().over(falling)).where(F.col("k") <= top)
    above = F.sum("m").over(falling.rowsBetween(W.unboundedPreceding, -1))
    wanted = leading.withColumn("above", F.coalesce(above, F.lit(0))).where(
        F.col("above") < top).select(*group, "value")
    chosen = cells.join(wanted, [*group, "value"]).select(*group, "n", "n_lang", "value")
    rank = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("value"), "item"))
    return (terms.join(chosen, [*group, "n", "n_lang"])
            .select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value")
            .withColumn("rank", rank).where(F.col("rank") <= top))


#: The same rows by definition: every kept term of every group.
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source FROM documents),
occ AS (SELECT i, lang, source, translate(unnest(regexp_extract_all(text,
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n_lang FROM occ GROUP BY ALL
    HAVING count(DISTINCT i) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
own AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term)
    GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY ALL),
shares AS (SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + 2)) // (coalesce(total, 0)::HUGEINT + 2 * v) AS p,
    1 + ({SCALE}::HUGEINT * (n_lang + 2)) // (total_lang::HUGEINT + 2 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
    LEFT JOIN own USING (lang, source, term) LEFT JOIN totals USING (lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item,
    sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares
  WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM parts) WHERE part = 'pair' OR rank <= {TOP}"""
