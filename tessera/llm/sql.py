"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Windows of ten words (or the whole shorter item) found in documents; proximity: every word at most
# two places off its place counted from the window's rarest word.
LEAKS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[k + 1 : k + least(10, len(w))] AS ph
        FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS k FROM b WHERE len(w) > 0)),
ph AS (SELECT row_number() OVER () AS pid, ph, len(ph) AS n, array_to_string(ph, ' ') AS t
       FROM (SELECT DISTINCT ph FROM win)),
own AS (SELECT ph.pid, win.item_id FROM ph JOIN win ON array_to_string(win.ph, ' ') = ph.t),
g AS (SELECT doc_id, k, n, array_to_string(w[k + 1 : k + n], ' ') AS t
      FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS k
            FROM d JOIN (SELECT DISTINCT n FROM ph) ON len(w) >= n)),
hit AS (SELECT g.doc_id, g.k, g.n, ph.pid FROM g JOIN ph USING (t)),
words_hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit
              FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
          FROM hit JOIN own USING (pid) GROUP BY doc_id),
f AS (SELECT word, count(*) AS c FROM p GROUP BY word),
pw AS (SELECT pid, n, unnest(ph) AS word, generate_subscripts(ph, 1) - 1 AS o FROM ph),
r AS (SELECT pid, n, first(word ORDER BY coalesce(c, 0), o) AS word, first(o ORDER BY coalesce(c, 0), o) AS o
      FROM pw LEFT JOIN f USING (word) GROUP BY pid, n),
cand AS (SELECT r.pid, r.n, p.doc_id, p.i - r.o AS s FROM r JOIN p USING (word)),
near AS (SELECT c.pid, c.doc_id FROM cand c JOIN pw USING (pid)
         JOIN p ON p.doc_id = c.doc_id AND p.word = pw.word AND p.i BETWEEN c.s + pw.o - 2 AND c.s + pw.o + 2
         GROUP BY c.pid, c.n, c.doc_id, c.s HAVING count(DISTINCT pw.o) = c.n),
close AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near JOIN own USING (pid) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN close USING (doc_id)
"""

RANKING = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY doc_id, word),
size AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // words) AS m FROM size, corpus),
q AS (SELECT item_id, word, count(*) AS times
      FROM (SELECT item_id, unnest({_WORDS}) AS word FROM benchmark) GROUP BY item_id, word),
weight AS (SELECT word, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM t, corpus GROUP BY word),
found AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM q JOIN t USING (word) JOIN weight USING (word) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                  doc_id, score FROM found WHERE score > 0)
SELECT * FROM placed WHERE rank <= 20
"""
