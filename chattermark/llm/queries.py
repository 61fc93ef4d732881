"""The registered queries: each applies one operator to its whole table.

Each `opN_` query derives the columns of its contract from what the operator
returns. `QUERIES` and `ORACLE_SQL` are what the driver entry adds.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark.llm import (
    decontamination,
    jaccardjoin,
    katz,
    linededup,
    merkle,
    mixing,
    neighbours,
    secretscan,
    sharding,
    spelling,
    toxicity,
    vectorcode,
    warc,
    windows,
)
from chattermark.llm.frames import read_table
from chattermark.sources.staging import new_folder, stage


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of held-out documents teach nothing."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, read_table(spark, sf_dir, "labels"), teaches=~held_out)
    return toxicity.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "evidence", "n_words"
    )


def op2_secretscan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, in the text itself and under its encodings."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secretscan.find_secrets(documents)

    def joined(spans: str):
        return F.concat_ws(",", F.expr(f"transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end))"))

    def count(kind: str):
        return F.expr(f"size(filter(base_spans, s -> s.kind = '{kind}'))").cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secretscan.KINDS],
        F.sha2(joined("base_spans"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        "n_layers",
        "n_unopened",
    )


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz and base scores of every document, learned from those not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.katz_scores(documents, held_out)


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, whose end comes from the next one."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return neighbours.map_descending(documents, EditedPair(), schema)


class EditedPair:
    """One row of `op4`; remembers the last fingerprint, as the next document comes right after."""

    def __init__(self) -> None:
        self.last: tuple[str, str] = ("", "")

    def __call__(self, doc_id: int | None, text: str | None, following: str | None) -> dict:
        text, following = text or "", following or ""
        known: dict = {}
        mark = self.last[1] if self.last[0] == text and self.last[1] else merkle.fingerprint(text, known)
        part = len(text) // 3
        edited = text[: len(text) - part] + following[:part]
        edited_mark = merkle.fingerprint(edited, known)
        next_mark = merkle.fingerprint(following)
        self.last = (following, next_mark)
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": mark,
            "edited_fingerprint": edited_mark,
            "near_edited": merkle.likeness(mark, edited_mark),
            "near_next": merkle.likeness(mark, next_mark),
        }


def op5_jaccardjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of similar documents that every document belongs to."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = jaccardjoin.similar_groups(documents, k=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    text = F.coalesce("text", F.lit(""))
    documents = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(text).alias("words"), F.md5(text).alias("text_md5")
    )
    mixed = mixing.mix(documents, size="words", identity=("doc_id", "text_md5"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to an archive and reads its records back."""
    folder = new_folder(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), folder)

    @F.pandas_udf("string")
    def digest(payloads: pd.Series) -> pd.Series:
        return payloads.map(warc.payload_digest)

    return warc.read_records(spark, folder).select(
        "page_id",
        F.length("payload").cast("long").alias("payload_bytes"),
        digest("payload").alias("payload_digest"),
        warc.header_type().alias("record_type"),
        warc.header_field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the row-count law."""
    text = F.coalesce("text", F.lit(""))
    documents = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("text_md5"),
    )
    placed = sharding.interleave(documents, identity=("doc_id", "text_md5"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of the benchmark found in a document; clean documents have no row."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(documents, read_table(spark, sf_dir, "benchmark"))


def op10_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document's lines that stay."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_shared_lines(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op11_vectorcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector under codebooks fitted to all of them."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vectorcode.fit(vectors)
    coded = stage(vectorcode.encode(vectors, books).drop("embedding"), "codes")
    return vectorcode.with_group_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the texts, some of whose words are misspelled."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = spelling.variant_groups(spelling.word_counts(documents, slips=97))
    return groups.select("word", "form", "root", "n", "n_near", "form_n")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = windows.pack(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def _codebook_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Rounds of assigning and averaging, one pair of CTEs each."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT v, p, arg_min(e, (d, e)) AS e, min(d) AS d
            FROM (
                SELECT x.v, x.p, b.e, CAST(list_sum([(x.x[i] - b.x[i]) * (x.x[i] - b.x[i])
                                                     FOR i IN range(1, len(x.x) + 1)]) AS BIGINT) AS d
                FROM pieces x JOIN b{i} b USING (p)
            ) GROUP BY v, p
        )""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (
            SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
            FROM (
                SELECT p, e, i, CAST(sum(x.x[i]) AS BIGINT) AS s, count(*) AS n
                FROM a{i} JOIN pieces x USING (v, p), range(1, len(x.x) + 1) r(i)
                GROUP BY p, e, i
            ) GROUP BY p, e
        ),
        b{i + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (p, e)
        )""")
    return f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS v,
                   [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        pieces AS MATERIALIZED (
            SELECT v, p, x[p * len(x) // {parts} + 1 : (p + 1) * len(x) // {parts}] AS x
            FROM kept, range({parts}) r(p)
        ),
        b0 AS (SELECT p, v - 1 AS e, x FROM pieces WHERE v <= {entries}),
        {",".join(steps).strip()},
        coded AS (
            SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                   CAST(sum(d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY v
        )
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds})
                   AS codebooks_sha256
        FROM kept JOIN coded USING (v)"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secretscan": op2_secretscan,
    "op3_katz": op3_katz,
    "op4_merkle": op4_merkle,
    "op5_jaccardjoin": op5_jaccardjoin,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_linededup": op10_linededup,
    "op11_vectorcode": op11_vectorcode,
    "op12_spelling": op12_spelling,
    "op13_packing": op13_packing,
}

ORACLE_SQL = {
    "op5_jaccardjoin": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        shingles AS (
            SELECT doc_id, unnest(list_distinct(
                [list_slice(w, i, i + 3) FOR i IN range(1, greatest(len(w) - 3, 1) + 1)])) AS s
            FROM words WHERE len(w) > 0
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 85 * (x.n + y.n - c)
        ),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (
            SELECT doc_id AS start, doc_id AS node FROM documents
            UNION
            SELECT start, b FROM reached JOIN edges ON node = a
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT start, min(node) AS c FROM reached GROUP BY start) ON start = d.doc_id""",
    "op6_mixing": r"""
        WITH d AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS s,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
                   md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                       || md5(coalesce(text, ''))) AS h
            FROM documents
        ),
        sized AS (
            SELECT s, CAST(sum(w) AS BIGINT) AS size,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY s = 'n', s) - 1) % 3 + 1] AS weight
            FROM d GROUP BY s
        ),
        roomy AS (
            SELECT *, 3.0::DOUBLE * size AS room, 3.0::DOUBLE * size / weight AS full_at,
                   CAST(sum(size) OVER () AS BIGINT) AS total
            FROM sized
        ),
        levels AS (
            SELECT *, (total - coalesce(sum(room) OVER (ORDER BY full_at, s
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight::DOUBLE) OVER (ORDER BY full_at, s
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM roomy
        ),
        targets AS (
            SELECT s, size, total, greatest(CAST(ceil(total / 100000) AS BIGINT), 1) AS block,
                   least(room, coalesce(max(CASE WHEN level <= full_at THEN level END) OVER (), 0)
                               * weight) AS target
            FROM levels
        ),
        seats AS (
            SELECT s, count(*) AS n
            FROM (
                SELECT s, row_number() OVER (ORDER BY target / (2 * i + 1) DESC, s, i) AS place,
                       CAST(ceil(total / block) AS BIGINT) AS house
                FROM (SELECT *, unnest(range(CAST(ceil(target / block) AS BIGINT) + 100)) AS i
                      FROM targets WHERE target > 0)
            )
            WHERE place <= house GROUP BY s
        ),
        plan AS (
            SELECT *, least(3 * k, CAST(round(coalesce(n, 0) * block * k / size) AS BIGINT)) AS u
            FROM (SELECT t.*, n, CAST(ceil(size / block) AS BIGINT) AS k,
                         CAST('0x' || substr(md5('42:' || s), 1, 8) AS BIGINT) AS shift
                  FROM targets t LEFT JOIN seats USING (s))
        ),
        placed AS (
            SELECT doc_id, s, w,
                   CAST(sum(w) OVER (PARTITION BY s ORDER BY h ROWS UNBOUNDED PRECEDING) AS BIGINT)
                       - w AS a
            FROM d
        )
        SELECT doc_id, CAST(w AS BIGINT) AS size, p.size AS source_size, target,
               CAST(CASE WHEN w = 0 THEN 0 ELSE list_sum([
                   (least(a + w, (j + 1) * block) - greatest(a, j * block))
                   * greatest(0, CAST(ceil((u - (j * 2147483647 + shift) % k) / k) AS BIGINT))
                   FOR j IN range(a // block, (a + w - 1) // block + 1)]) END AS BIGINT) AS taken
        FROM placed JOIN plan p USING (s)""",
    "op7_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
        ),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
        SELECT page_id, strlen(body) AS payload_bytes,
               array_to_string([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT)
                               >> (15 - 5 * (i % 4))) & 31), 1)
                   FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM f""",
    "op8_sharding": """
        WITH crc AS (
            SELECT list(c ORDER BY n) AS t
            FROM (SELECT n, list_reduce([n] || range(8), lambda a, k: CASE WHEN a & 1 = 1
                      THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(n))
        ),
        d AS (
            SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
                   xor(list_reduce(
                       [4294967295] || [CAST('0x' || x AS BIGINT) FOR x IN
                           regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
                       lambda a, b: xor(a >> 8, crc.t[xor(a & 255, b) + 1])), 4294967295)
                       AS text_crc32,
                   md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                       || md5(coalesce(text, ''))) AS h
            FROM documents, crc
        ),
        f AS (
            SELECT d.*, (turns * (row_number() OVER (PARTITION BY source ORDER BY h) - 1) + phase)
                      / (turns * count(*) OVER (PARTITION BY source)) AS fraction
            FROM d JOIN (
                SELECT source AS s, 2 * row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS phase,
                       2 * count(*) OVER () AS turns
                FROM (SELECT DISTINCT source FROM documents)
            ) ON source IS NOT DISTINCT FROM s
        ),
        p AS (
            SELECT *, row_number() OVER (ORDER BY fraction, h, source) - 1 AS position,
                   count(*) OVER () AS total
            FROM f
        ),
        s AS (SELECT *, ((position + 1) * 8 - 1) // total AS shard FROM p),
        SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
               position - (shard * total) // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM s""",
    "op10_linededup": f"""
        WITH lines AS (
            SELECT doc_id, i, line,
                   trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
            FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l
                        FROM documents))
        ),
        shared AS (
            SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ),
        marked AS (
            SELECT doc_id, i, line, coalesce(doc_id <> keeper, FALSE) AS gone
            FROM lines LEFT JOIN shared USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op11_vectorcode": _codebook_sql(),
    "op12_spelling": """
        WITH RECURSIVE crc AS (
            SELECT list(c ORDER BY n) AS t
            FROM (SELECT n, list_reduce([n] || range(8), lambda a, k: CASE WHEN a & 1 = 1
                      THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(n))
        ),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
                   count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run
                  FROM documents)
            GROUP BY ALL
        ),
        hashed AS (
            SELECT w, n, xor(list_reduce(
                       [4294967295] || [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(
                           hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)), '..')],
                       lambda a, b: xor(a >> 8, crc.t[xor(a & 255, b) + 1])), 4294967295) AS h
            FROM runs, crc WHERE length(w) >= 5
        ),
        vocabulary AS MATERIALIZED (
            SELECT w, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT n, CASE WHEN h % 97 = 0 THEN w[: h % length(w)] || w[h % length(w) + 2 :]
                                 ELSE w END AS w FROM hashed)
            WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3
        ),
        shorter AS MATERIALIZED (
            SELECT w, i, w[: i - 1] || w[i + 1 :] AS s
            FROM vocabulary, range(1, length(w) + 1) r(i)
        ),
        near AS MATERIALIZED (
            SELECT DISTINCT a.w, b.w AS o FROM shorter a JOIN shorter b USING (i, s) WHERE a.w <> b.w
            UNION
            SELECT a.w, b.w FROM shorter a JOIN vocabulary b ON a.s = b.w
            UNION
            SELECT b.w, a.w FROM shorter a JOIN vocabulary b ON a.s = b.w
        ),
        best AS (
            SELECT near.w, count(*) AS n_near, max(v.n) AS most, arg_min(near.o, (-v.n, near.o)) AS o
            FROM near JOIN vocabulary v ON v.w = near.o GROUP BY near.w
        ),
        formed AS MATERIALIZED (
            SELECT v.w, v.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN most >= 2 * v.n THEN o END AS form,
                   CASE WHEN most >= 2 * v.n THEN most END AS form_n
            FROM vocabulary v LEFT JOIN best USING (w)
        ),
        followed AS (
            SELECT w, w AS at FROM formed
            UNION ALL
            SELECT followed.w, f.form FROM followed JOIN formed f ON f.w = followed.at
            WHERE f.form IS NOT NULL
        )
        SELECT f.w AS word, f.form, r.at AS root, f.n, f.n_near, f.form_n
        FROM formed f JOIN followed r USING (w) JOIN formed l ON l.w = r.at AND l.form IS NULL""",
}
