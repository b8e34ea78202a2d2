"""DuckDB SQL of queries of this subpackage, over whole tables, written from the contracts and not from the operators."""

from __future__ import annotations

from sensorflow.llm.common import LOWER, UPPER

_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"


def _sketch(text: str) -> str:
    """The 128 smallest distinct shingle hashes (5 words, first 12 hex digits of the MD5) of a text."""
    words = f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"
    return (f"list_sort(list_distinct(list_transform([{words}], lambda w: CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE "
            "list_transform(range(greatest(len(w) - 4, 1)), lambda i: left(md5(array_to_string(w[i + 1:i + 5], ' ')), 12)) END)[1]))[1:128]")


def _near(a: str, b: str) -> str:
    return (f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 ELSE list_transform([list_sort(list_distinct(list_concat({a}, {b})))[1:128]], "
            f"lambda u: CAST(len(list_intersect(u, list_intersect({a}, {b}))) AS DOUBLE) / len(u))[1] END")


OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt
      FROM (SELECT DISTINCT doc_id, t FROM d) WINDOW w AS (ORDER BY doc_id NULLS FIRST, md5(t))),
e AS (SELECT doc_id, t, nt, left(t, length(t) - length(t) // 2) || left(nt, length(t) // 2) AS et FROM o),
s AS (SELECT doc_id, t, et, {_sketch("t")} AS a, {_sketch("et")} AS b, {_sketch("nt")} AS c FROM e),
f AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n_chars, sha256(et) AS edited_sha256, array_to_string(a, '') AS fingerprint,
             array_to_string(b, '') AS edited_fingerprint, CAST({_near("a", "b")} AS DOUBLE) AS near_edited,
             CAST({_near("a", "c")} AS DOUBLE) AS near_next FROM s)
SELECT f.* EXCLUDE (t) FROM d JOIN f ON d.doc_id IS NOT DISTINCT FROM f.doc_id AND d.t = f.t"""


def _op12() -> str:
    """Vectors as four lists; each round joins every part with every entry of its codebook."""
    out = ["""WITH v AS MATERIALIZED (
SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
       list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS e
FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, i AS p, e[i * len(e) // 4 + 1:(i + 1) * len(e) // 4] AS x FROM v, range(4) t(i)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS k, x AS y FROM p WHERE r <= 256)"""]
    nearest = """n{i} AS MATERIALIZED (SELECT r, p, min(d) AS d, arg_min(k, (d, k)) AS k
FROM (SELECT r, p, k, CAST(list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
      FROM p JOIN b{i} USING (p)) GROUP BY r, p)"""
    for i in range(4):
        out.append(nearest.format(i=i))
        out.append(f"""m{i} AS (SELECT p, k, list(CAST(floor(s / c) AS BIGINT) ORDER BY j) AS y
FROM (SELECT p, k, j, sum(x[j]) AS s, count(*) AS c FROM n{i} JOIN p USING (r, p), range(1, 17) t(j) GROUP BY p, k, j) GROUP BY p, k),
b{i + 1} AS MATERIALIZED (SELECT p, k, coalesce(m{i}.y, b{i}.y) AS y FROM b{i} LEFT JOIN m{i} USING (p, k))""")
    out.append(nearest.format(i=4))
    out.append("""c AS (SELECT r, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM n4 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c JOIN v USING (r), h""")
    return ",\n".join(out[:-1]) + ",\n" + out[-1]


OP12 = _op12()

OP13 = f"""
WITH digits AS (SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
dw AS MATERIALIZED (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY r, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY w),
bytes AS (SELECT w, list_transform(range(octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)) AS y
          FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
codes AS MATERIALIZED (SELECT w, xor(list_reduce(y, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) % 10000 AS k FROM bytes, digits),
s AS (SELECT k, sum(n) AS s FROM dw JOIN codes USING (w) GROUP BY k),
t AS (SELECT k, sum(n) AS t FROM bw JOIN codes USING (w) GROUP BY k),
g AS MATERIALIZED (SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) AS DOUBLE)
        / CAST((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000) AS DOUBLE))) AS BIGINT) AS gain
      FROM range(10000) r(k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
weights AS (SELECT r, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM dw JOIN codes USING (w) JOIN g USING (k) GROUP BY r),
scores AS (SELECT r, doc_id, coalesce(len(w), 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
        (CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
      FROM d LEFT JOIN weights USING (r)),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN ranks USING (r)"""
