"""The registered queries of the numbered operators and of the pipeline, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from worklink.llm import (
    bpe, context_tree, divergence, embeddings, exact, fingerprints, jaccard, language, packing, quality, runs, token_counts, urls)
from worklink.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rules of the URL filter: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def reached(links: str) -> str:
    """CTE `reach` (node, origin): what can be reached over a relation of links (a, b)."""
    return f"""ways AS (SELECT a, b FROM {links} UNION ALL SELECT b, a FROM {links}),
reach AS (SELECT a AS node, a AS origin FROM ways UNION SELECT ways.b, reach.origin FROM reach JOIN ways ON ways.a = reach.node)"""


ORACLES["op1_near_vectors"] = f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
{reached('links')}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM ways GROUP BY a) d ON d.a = vec_id
  LEFT JOIN (SELECT node, min(origin) AS low FROM reach GROUP BY node) c ON c.node = vec_id"""

BLANK_RUN = r"'[\x20\x09-\x0D]+'"

ORACLES["op6_jaccard"] = f"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {BLANK_RUN}), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
{reached('links')}
SELECT doc_id, len(s) AS n_shingles, coalesce(low, doc_id) AS component_id
FROM sets LEFT JOIN (SELECT node, min(origin) AS low FROM reach GROUP BY node) c ON c.node = doc_id"""

ORACLES["op11_exact_dedup"] = f"""SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), {BLANK_RUN}, ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""

#: CTE `hashed` (doc_id, h): the crc32 of an id's decimal digits, bit by bit.
CRC_OF_ID = """hashed AS (SELECT doc_id, xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
  lambda crc, byte: list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
  4294967295)) AS h FROM documents)"""

ORACLES["op12_periodic_runs"] = f"""WITH {CRC_OF_ID},
plain AS (SELECT doc_id, h, h // 10 AS g, list_filter(regexp_split_to_array(coalesce(text, ''), {BLANK_RUN}), lambda x: x <> '') AS w
  FROM documents JOIN hashed USING (doc_id)),
places AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS chosen, CASE WHEN len(w) > 0 THEN g % len(w) ELSE 0 END AS a, 3 + g % 8 AS part FROM plain),
texts AS (SELECT doc_id, CASE WHEN chosen THEN list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i
  ELSE a + (i - a) % (1 + (len(w) - a) // part) END]) ELSE w END AS w FROM places),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
equal AS (SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches GROUP BY doc_id, s, l),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t,
  min_by(struct_pack(s := s, l := l, q := q), struct_pack(a := -l, b := s, c := q)) AS best FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, 1000 * best.l // best.q AS exponent_milli,
  sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(rest.t, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN rest USING (doc_id)"""

ORACLES["op13_source_divergence"] = r"""WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz')) AS terms FROM documents),
hits AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM hits GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS c FROM hits SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, count(*) AS v, sum(c)::BIGINT AS n FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(c)::BIGINT AS n FROM counts GROUP BY lang, source),
groups AS (SELECT g.lang, g.source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN totals USING (lang, source)),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000 * (coalesce(c.c, 0) + 5) // (g.n + 5 * s.v) AS p,
    1 + 1000000000 * (k.c + 5) // (s.n + 5 * s.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS f FROM grid x JOIN grid y
  ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f, 0) AS value FROM groups x JOIN groups y
  ON x.lang = y.lang AND x.source <> y.source LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM grid WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


@query
def op1_near_vectors(spark, sf_dir):
    """All vectors against each other by cosine of at least 0.95."""
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op2_token_counts(spark, sf_dir):
    """Best unigram segmentation of every whole text, counted."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op3_quality(spark, sf_dir):
    """Quality of every whole text, learned from three quarters of the labels."""
    return quality.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), keep=0.7)


@query
def op4_bpe(spark, sf_dir):
    """Every whole text encoded and decoded again."""
    return bpe.bpe_roundtrip(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op5_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), size=2048, end_id=1)


@query
def op6_jaccard(spark, sf_dir):
    """Components of documents with a Jaccard similarity of at least 0.9 on three-word shingles."""
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


@query
def op7_url_filter(spark, sf_dir):
    """Verdicts on all page addresses."""
    return urls.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op8_language_id(spark, sf_dir):
    """Language of every whole text, learned from four fifths of the ids."""
    return language.identify_languages(read_table(spark, sf_dir, "documents"))


@query
def op9_lm_scores(spark, sf_dir):
    """Log probabilities of every whole text, learned from nine tenths of the ids."""
    return context_tree.model_scores(read_table(spark, sf_dir, "documents"))


@query
def op10_fingerprints(spark, sf_dir):
    """Fingerprints of every whole text, of its edited text, and their likeness."""
    return fingerprints.document_fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op11_exact_dedup(spark, sf_dir):
    """Groups of equal whole texts, the smallest id of each stays."""
    found = exact.exact_duplicates(read_table(spark, sf_dir, "documents"), digests=True)
    return found.withColumnRenamed("digest", "text_sha256")


@query
def op12_periodic_runs(spark, sf_dir):
    """Runs of every whole text, a tenth of which are made periodic, and the texts without repeated periods."""
    return runs.run_digests(runs.periodic_runs(runs.planted(read_table(spark, sf_dir, "documents"))))


@query
def op13_source_divergence(spark, sf_dir):
    """Sources of each language against each other and against the language."""
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"), min_docs=30, top=50)
