"""The queries of this package, with SQL where it can state them."""

from __future__ import annotations

from itinera.llm import bpe, chat, covertree, language, minhash, packing, postings, ptolemy, runs, secret_scan, suffix, toxicity, webarchive

QUERIES = {
    "op1_cover_tree": covertree.op1,
    "op2_bpe": bpe.op2,
    "op3_language": language.op3,
    "op4_minhash": minhash.op4,
    "op5_packing": packing.op5,
    "op6_suffix": suffix.op6,
    "op7_secret_scan": secret_scan.op7,
    "op8_chat": chat.op8,
    "op9_postings": postings.op9,
    "op10_toxicity": toxicity.op10,
    "op11_ptolemaic": ptolemy.op11,
    "op12_runs": runs.op12,
    "op13_warc": webarchive.op13,
}

# A graph's components by recursion: the smallest number reachable.
_REACH = """reach AS (SELECT a AS node, a AS top FROM both_ways UNION SELECT e.a, r.top FROM reach r JOIN both_ways e ON e.b = r.node),
parts AS (SELECT node, min(top) AS component FROM reach GROUP BY node)"""

_OP1 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
both_ways AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id WHERE list_cosine_similarity(p.x, q.x) >= 0.98),
{_REACH},
n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(component, vec_id)) AS component_id, least(vec_id, coalesce(component, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN parts ON node = vec_id"""

_OP4 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\v\f\r]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(component, d.doc_id)) AS component_id, least(d.doc_id, coalesce(component, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN parts ON node = d.doc_id"""

_OP6 = """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, len(h) // 2 AS n FROM h),
p AS (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM b WHERE n >= 200),
k AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 400)) AS k FROM p),
d AS (SELECT doc_id, i FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM d),
r AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS z FROM r GROUP BY doc_id, run),
o AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
t AS (SELECT o.doc_id, count(*) AS runs, sum(z - a) AS gone, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept FROM o JOIN b ON b.doc_id = o.doc_id GROUP BY o.doc_id)
SELECT b.doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM b LEFT JOIN t ON t.doc_id = b.doc_id"""

_OP8 = r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(role) + length(regexp_replace(role, '[^\\<>\n]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\<]', '', 'g'))) + count(*) - 1 AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

# Of the others, op9 is approximate, and SQL has neither the tokenizers, nor the trained models, nor spans of patterns; runs of
# words (op12) would take it a comparison for each word and period.
ORACLES: dict[str, str] = {"op1_cover_tree": _OP1, "op4_minhash": _OP4, "op6_suffix": _OP6, "op8_chat": _OP8, "op11_ptolemaic": ptolemy.sql(), "op13_warc": webarchive.SQL}
