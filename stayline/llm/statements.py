"""DuckDB statements of the training-data queries that SQL can express."""

from __future__ import annotations

from stayline.llm.common import LOWER, UPPER
from stayline.llm.licenses import COVERAGE, DRIFT, GRAM, TEMPLATES
from stayline.llm.ranked_search import TERM


def _words(source: str, key: str) -> str:
    return (
        f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
        rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {source}"
    )


CONTAINED = f"""
WITH d AS ({_words("documents", "doc_id")}),
i AS (SELECT *, least(5, len(w)) AS k FROM ({_words("benchmark", "item_id")}) q WHERE len(w) > 0),
item_shingles AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS s
  FROM i, unnest(range(1, len(w) - k + 2)) AS u(p)),
sizes AS (SELECT DISTINCT k FROM i),
document_shingles AS (SELECT DISTINCT doc_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS s
  FROM (SELECT * FROM d, sizes WHERE len(w) >= k) e, unnest(range(1, len(w) - k + 2)) AS u(p)),
sized AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, CAST(count(*) AS DOUBLE) / n AS containment
FROM document_shingles JOIN item_shingles USING (k, s) JOIN sized USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= ceil(0.8 * n - 1e-9)"""


def _template_rows() -> str:
    rows = []
    for number, t in enumerate(TEMPLATES):
        words = t.words.split()
        grams = len(words) - GRAM + 1
        rows += [
            f"({number}, '{t.label}', {str(t.exact).lower()}, {grams}, {p}, '{' '.join(words[p : p + GRAM])}')" for p in range(grams)
        ]
    return ", ".join(rows)


LICENSES = f"""
WITH d AS ({_words("documents", "doc_id")}),
t(template, label, exact, grams, t_pos, g) AS (VALUES {_template_rows()}),
rolled AS (SELECT doc_id, p AS pos, array_to_string(list_slice(w, p + 1, p + {GRAM}), ' ') AS g
  FROM d, unnest(range(0, len(w) - {GRAM} + 1)) AS u(p) WHERE len(w) >= {GRAM}),
hits AS (SELECT doc_id, template, label, exact, grams, pos - t_pos AS diagonal, pos, t_pos FROM rolled JOIN t USING (g)),
votes AS (SELECT doc_id, template, diagonal, count(*) AS n FROM hits GROUP BY ALL),
steps AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS apart FROM votes),
bundles AS (SELECT *, sum(CASE WHEN apart IS NULL OR apart > {DRIFT} THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS bundle FROM steps),
places AS (
  SELECT doc_id, label, true AS exact, diagonal AS start, CAST(1 AS DOUBLE) AS coverage
  FROM hits WHERE exact GROUP BY doc_id, template, label, grams, diagonal HAVING count(*) = grams
  UNION ALL
  SELECT doc_id, label, false, min(pos), count(DISTINCT t_pos) / CAST(grams AS DOUBLE)
  FROM hits JOIN bundles USING (doc_id, template, diagonal) WHERE NOT exact
  GROUP BY doc_id, template, label, grams, bundle
  HAVING max(pos) + {GRAM} - min(pos) <= grams + {GRAM} + 2 * {DRIFT}),
found AS (SELECT doc_id, count(*) FILTER (WHERE exact) AS n_base, min(start) FILTER (WHERE exact) AS first_word,
  max(start) FILTER (WHERE exact) AS last_word,
  array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE exact)), ',') AS base_labels,
  array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE coverage >= {COVERAGE})), ',') AS labels,
  max(coverage) AS score FROM places GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM d LEFT JOIN found USING (doc_id)"""


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"

RANKED = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000.0::DOUBLE * ln((2.0::DOUBLE * docs + 2.0) / (2.0::DOUBLE * count(*) + 1.0))) AS BIGINT) AS w
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(t) * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""
