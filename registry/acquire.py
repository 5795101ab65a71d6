"""Scans, sinks and joins. Dumps are written from the given tables first, every row of them."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from qalathe import schemas as S
from qalathe import sources
from qalathe.plans import acquire as plan
from qalathe.plans import training, validate
from qalathe.session import fresh_path

from . import working as W
from .working import given, over_documents, qa_processed, qa_stage

_ID = "CAST(doc_id + 1 AS VARCHAR(20))"

QUESTIONS_SQL = f"""
SELECT {_ID} AS Id, 'Item ' || CAST(doc_id AS VARCHAR(20)) || ' &amp; more' AS Title,
       '<p>' || {W._phrase_case()} || '</p> "quoted", ' || text AS Body,
       CASE WHEN doc_id % 50 = 49 THEN 'n/a' WHEN doc_id % 50 = 48 THEN ''
            ELSE CAST((doc_id * 37) % 101 AS VARCHAR(20)) END AS Score,
       CASE WHEN doc_id % 7 = 0 THEN ' ' ELSE CAST(doc_id + 1000001 AS VARCHAR(20)) END AS AcceptedAnswerId,
       '<' || lang || '><' || source || '>' AS Tags,
       CAST((doc_id * 7919) % 100003 AS VARCHAR(20)) AS ViewCount,
       '2024-01-01' AS CreationDate, doc_id
FROM documents
"""
# Two answers for every other question, none for the rest; the later one counts.
ANSWERS_SQL = """
SELECT CASE WHEN doc_id % 97 = 96 THEN '0' ELSE CAST(doc_id + 1000001 AS VARCHAR(20)) END AS AnswerId,
       CAST(doc_id - doc_id % 2 + 1 AS VARCHAR(20)) AS QuestionId,
       '<pre>' || text || '</pre> &lt;b&gt; &copy;' AS AnswerBody,
       CASE WHEN doc_id % 89 = 88 THEN 'many' ELSE CAST((doc_id * 53) % 97 - 9 AS VARCHAR(20)) END AS AnswerScore,
       doc_id
FROM documents
"""


def _dump(spark, sf_dir, sql, label):
    """The rows as CSV files whose names follow the row order."""
    path = fresh_path(spark, label)
    sources.write_csv(over_documents(spark, sf_dir, sql).orderBy("doc_id").drop("doc_id"), path)
    return path


def _questions(spark, sf_dir):
    path = _dump(spark, sf_dir, QUESTIONS_SQL, "questions")
    return plan.wellformed_questions(sources.read_questions_csv(spark, path))


def _answers(spark, sf_dir):
    path = _dump(spark, sf_dir, ANSWERS_SQL, "answers")
    return plan.wellformed_answers(sources.read_answers_csv(spark, path))


def _questions_split(spark, sf_dir):
    path = _dump(spark, sf_dir, QUESTIONS_SQL, "questions")
    return plan.wellformed_questions(sources.read_questions_csv_split(spark, path))


def _answers_split(spark, sf_dir):
    path = _dump(spark, sf_dir, ANSWERS_SQL, "answers")
    return plan.wellformed_answers(sources.read_answers_csv_split(spark, path))


def _text_digest(df, *columns):
    return df.withColumns({c: F.md5(c) for c in columns})


def question_csv(spark, sf_dir):
    out = _questions(spark, sf_dir).withColumn("tags", F.concat_ws("|", "tags"))
    return _text_digest(out, "body")


def answer_csv(spark, sf_dir):
    from qalathe.operators import last_per_key

    return _text_digest(last_per_key(_answers(spark, sf_dir), "question_id"), "body")


def question_csv_split(spark, sf_dir):
    """The question dump read by split, though its fields hold line breaks."""
    out = _questions_split(spark, sf_dir).withColumn("tags", F.concat_ws("|", "tags"))
    return _text_digest(out, "body")


def answer_csv_split(spark, sf_dir):
    """The answer dump read by split; the later answer of a question counts, by place in the files."""
    from qalathe.operators import last_per_key

    return _text_digest(last_per_key(_answers_split(spark, sf_dir), "question_id"), "body")


def csv_pairs(spark, sf_dir):
    pairs = plan.pairs_by_question(_questions(spark, sf_dir), _answers(spark, sf_dir))
    return _text_digest(pairs.withColumn("tags", F.concat_ws("|", "tags")), "question_body", "answer_body")


def acquisition_counts(spark, sf_dir):
    questions, answers = _questions(spark, sf_dir), _answers(spark, sf_dir)
    return plan.acquisition_counts(questions, plan.pairs_by_question(questions, answers))


def acquisition_counts_observed(spark, sf_dir):
    """The counts of the acquisition stage, observed in the pass that writes its pairs."""
    return plan.acquire_pairs(_questions(spark, sf_dir), _answers(spark, sf_dir), fresh_path(spark, "pairs"))


def _in_responses(rows, schema, size=100):
    """``rows`` (group, item) as responses of at most ``size`` items of one group, in the shape of
    ``schema``. They are cut from the batches a task reads, so no row is shuffled for them and no
    group is gathered."""
    group, items = schema.fieldNames()

    def run(batches):
        for batch in batches:
            codes = batch.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            found = codes[order]
            first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.array([], int)
            sizes = np.diff(np.r_[first, len(found)])
            cuts = np.concatenate([np.arange(s, s + n, size) for s, n in zip(first, sizes)] + [[len(found)]])
            if len(cuts) > 1:
                taken = batch.take(pa.array(order))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(0).take(pa.array(cuts[:-1])),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), taken.column(1))], names=[group, items])

    return rows.mapInArrow(run, schema)


def _landed_questions(spark, sf_dir):
    """Responses of at most 100 items, by language and again by a second tag, as JSON lines."""
    docs = given(spark, sf_dir, "documents")
    item = F.struct(
        (F.col("doc_id") + 1).alias("question_id"),
        F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") * 2 + 10).alias("accepted_answer_id"),
        F.concat(F.col("tag"), F.lit(" &quot;"), F.col("doc_id")).alias("title"), F.col("text").alias("body"),
        F.array("lang", "source").alias("tags"), (F.col("doc_id") % 101).cast("long").alias("score"),
        (F.col("doc_id") % 1009).cast("long").alias("view_count"))
    rows = docs.withColumn("tag", F.explode(F.array("lang", F.lit("all")))).select("tag", item.alias("item"))
    path = fresh_path(spark, "landed-questions")
    sources.write_jsonl(_in_responses(rows, S.LANDED_QUESTIONS), path)
    return path


def _landed_answers(spark, sf_dir):
    """Responses of at most 100 answers. Answer ids repeat between batches, the later batch counts."""
    docs = given(spark, sf_dir, "documents")
    answer = F.struct(
        (F.col("doc_id") * 2 + 10).alias("answer_id"),
        F.concat(F.lit("<i>"), F.col("batch").cast("string"), F.lit("</i> "), F.col("text")).alias("body"),
        (F.col("doc_id") % 89 - F.col("part")).cast("long").alias("score"))
    rows = docs.withColumn("part", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "batch", F.expr("doc_id div 100") * 2 + F.col("part")).select("batch", answer.alias("item"))
    path = fresh_path(spark, "landed-answers")
    sources.write_jsonl(_in_responses(rows, S.LANDED_ANSWERS), path)
    return path


def _write_documents(rows, path, head, tail):
    """``rows`` (tag, item) as files that each hold one JSON document: the items of one tag in one
    input split, after ``head(tag)`` and before ``tail``. The items pass through; none are gathered."""
    def run(batches):
        seen, n = {}, 0
        for batch in batches:
            tags, before = batch.column(0).to_pylist(), []
            for tag in tags:
                before.append("," if tag in seen else head(tag))
                seen.setdefault(tag, len(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen[t] for t in tags], pa.int32()), pa.array(range(n, n + len(tags)), pa.int64()),
                 pc.binary_join_element_wise(pa.array(before, pa.string()), batch.column(1).cast(pa.string()), "")],
                names=["document", "n", "value"])
            n += len(tags)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.values(), pa.int32()), pa.array([n] * len(seen), pa.int64()),
                 pa.array([tail] * len(seen), pa.string())], names=["document", "n", "value"])

    pieces = rows.mapInArrow(run, "document int, n long, value string")
    pieces.sortWithinPartitions("document", "n").select("document", "value").write.partitionBy("document").text(path)


_TAG_ORDER = ("en", "all")


def landed_questions(spark, sf_dir):
    path = _landed_questions(spark, sf_dir)
    out = plan.distinct_landed_questions(sources.landed_questions(spark, path, _TAG_ORDER, lines=True))
    return _text_digest(out.withColumn("tags", F.concat_ws("|", "tags")), "body")


def landed_answers(spark, sf_dir):
    path = _landed_answers(spark, sf_dir)
    out = plan.distinct_landed_answers(sources.landed_answers(spark, path, lines=True))
    return _text_digest(out, "body")


def landed_pairs(spark, sf_dir):
    q, a = _landed_questions(spark, sf_dir), _landed_answers(spark, sf_dir)
    pairs = plan.pairs_by_accepted_answer(
        plan.distinct_landed_questions(sources.landed_questions(spark, q, _TAG_ORDER, lines=True)),
        plan.distinct_landed_answers(sources.landed_answers(spark, a, lines=True)))
    return _text_digest(pairs.withColumn("tags", F.concat_ws("|", "tags")), "question_body", "answer_body")


def json_arrays(spark, sf_dir):
    """Pairs as JSON arrays of at most 100 records, scanned back."""
    base = W.qa_base(spark, sf_dir)
    arrays = base.groupBy(F.expr("question_id div 100")).agg(
        F.to_json(F.collect_list(F.struct(*base.columns))).alias("value")).select("value")
    path = fresh_path(spark, "json-arrays")
    arrays.write.text(path)
    out = sources.read_json_array(spark, path, S.QA_PAIRS, lines=True)
    return _text_digest(out.withColumn("tags", F.concat_ws("|", "tags")), "question_body", "answer_body")


def json_document_split(spark, sf_dir):
    """Pairs as files that each hold one JSON array (the rows of one input split), read back by split."""
    base = W.qa_base(spark, sf_dir)
    path = fresh_path(spark, "json-documents")
    rows = base.select(F.lit(None).cast("string").alias("tag"), F.to_json(F.struct(*base.columns)).alias("item"))
    _write_documents(rows, path, lambda _: "[", "]")
    # Nothing but the brackets lies outside the items.
    out = sources.read_json_items(spark, path, S.QA_PAIRS, outside=F.lit(None)).drop("_pos", "_outside")
    return _text_digest(out.withColumn("tags", F.concat_ws("|", "tags")), "question_body", "answer_body")


def landed_question_documents(spark, sf_dir):
    """Landed question responses as one document per tag and input split, each a file, read back by split."""
    path = _landed_questions(spark, sf_dir)
    single = fresh_path(spark, "landed-documents")
    responses = spark.read.schema(S.LANDED_QUESTIONS).json(path)
    rows = responses.select("tag", F.explode("items").alias("item")).select("tag", F.to_json("item").alias("item"))
    _write_documents(rows, single, lambda tag: f'{{"tag":{json.dumps(tag)},"items":[', "]}")
    out = plan.distinct_landed_questions(sources.landed_question_documents(spark, single, _TAG_ORDER))
    return _text_digest(out.withColumn("tags", F.concat_ws("|", "tags")), "body")


def csv_sink(spark, sf_dir):
    path = fresh_path(spark, "processed-csv")
    sources.write_csv(qa_processed(spark, sf_dir), path)
    back = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return back.select(
        F.col("question_id").cast("long").alias("question_id"), "tags", "error_signatures",
        "question_metrics", F.md5("question_body").alias("question_md5"),
        F.md5("answer_body").alias("answer_md5"),
        F.col("quality_score").cast("double").alias("quality_score"))


def jsonl_sink(spark, sf_dir):
    path = fresh_path(spark, "chat")
    chat = training.chat_examples(qa_processed(spark, sf_dir), system_prompt=None, weighted=False)
    sources.write_jsonl(chat, path)
    back = spark.read.schema(chat.schema).json(path)
    return back.select(
        "metadata.question_id", "metadata.quality_score", F.concat_ws("|", "metadata.tags").alias("tags"),
        F.md5(F.col("messages")[0]["content"]).alias("user_md5"),
        F.md5(F.col("messages")[1]["content"]).alias("assistant_md5"))


def report_sink(spark, sf_dir):
    """Quality checks written as a report and read as an optional one."""
    path = fresh_path(spark, "checks")
    sources.write_json(validate.quality_checks(W.qa_base(spark, sf_dir)), path)
    back = sources.optional_json(spark, path, S.CHECKS)
    return back.select(F.col("ordinal").cast("long").alias("ordinal"), "check", "column", "status", "message")


def source_fallback(spark, sf_dir):
    """The validated table is not there, so the processed one is read."""
    processed = fresh_path(spark, "processed")
    sources.write_table(qa_processed(spark, sf_dir), processed)
    out = sources.first_available(spark, fresh_path(spark, "validated"), processed)
    return out.select("question_id", "question_type", "quality_score")


def promoted_table(spark, sf_dir):
    """A valid table goes to its validated place, and that place is then preferred."""
    table = qa_stage(spark, sf_dir)
    place = fresh_path(spark, "validated")
    checks = validate.quality_checks(table)
    validate.promote(table, checks, place)
    found = validate.read_validated(spark, place)
    out = found if found is not None else sources.first_available(spark, fresh_path(spark, "processed"))
    return out.select("question_id", "complexity", "quality_score")


QUERIES = {
    "question_csv_scan": question_csv,
    "answer_csv_scan": answer_csv,
    "question_csv_split": question_csv_split,
    "json_document_split": json_document_split,
    "landed_question_documents": landed_question_documents,
    "answer_csv_split": answer_csv_split,
    "csv_pairs": csv_pairs,
    "acquisition_counts": acquisition_counts,
    "acquisition_counts_observed": acquisition_counts_observed,
    "landed_questions": landed_questions,
    "landed_answers": landed_answers,
    "landed_pairs": landed_pairs,
    "json_array_scan": json_arrays,
    "csv_sink": csv_sink,
    "jsonl_sink": jsonl_sink,
    "report_sink": report_sink,
    "source_fallback": source_fallback,
    "promoted_table": promoted_table,
}


# --- SQL ------------------------------------------------------------------------------

def _plain(c: str) -> str:
    out = rf"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def _int(c: str) -> str:
    return f"CASE WHEN coalesce({c}, '') = '' THEN 0 ELSE TRY_CAST({c} AS BIGINT) END"


_TABLES = f"""
questions AS ({QUESTIONS_SQL}),
answers AS ({ANSWERS_SQL}),
q AS (SELECT TRY_CAST(Id AS BIGINT) AS question_id, Title AS title, Body AS body, {_int('Score')} AS score,
        TRY_CAST(AcceptedAnswerId AS BIGINT) AS accepted_answer_id,
        regexp_extract_all(Tags, '<([^>]+)>', 1) AS tags, {_int('ViewCount')} AS view_count,
        CreationDate AS creation_date
      FROM questions WHERE {_int('Score')} >= 5 AND trim(AcceptedAnswerId) <> ''),
valid AS (SELECT {_int('AnswerId')} AS answer_id, {_int('QuestionId')} AS question_id, AnswerBody AS body,
        {_int('AnswerScore')} AS score, doc_id FROM answers),
a AS (SELECT question_id, arg_max(answer_id, doc_id) AS answer_id, arg_max(body, doc_id) AS body,
        arg_max(score, doc_id) AS score
      FROM valid WHERE answer_id <> 0 AND question_id <> 0 AND score IS NOT NULL GROUP BY question_id),
pairs AS (SELECT q.question_id, {_plain('title')} AS title, {_plain('q.body')} AS question_body,
        array_to_string(tags, '|') AS tags, q.score, view_count, {_plain('a.body')} AS answer_body,
        a.score AS answer_score FROM q JOIN a ON q.question_id = a.question_id)"""

_LANDED_Q = """lq AS (SELECT doc_id + 1 AS question_id, doc_id * 2 + 10 AS accepted_answer_id,
  CASE WHEN lang = 'en' THEN 'en' ELSE 'all' END || ' &quot;' || doc_id AS title, text AS body,
  lang || '|' || source AS tags, doc_id % 101 AS score, doc_id % 1009 AS view_count
  FROM documents WHERE doc_id % 5 <> 0)"""
_LANDED_A = """la AS (SELECT doc_id * 2 + 10 AS answer_id,
  '<i>' || CAST((doc_id // 100) * 2 + 1 AS VARCHAR) || '</i> ' || text AS body, doc_id % 89 - 1 AS score
  FROM documents)"""

ORACLE = {
    "question_csv_scan": f"""
WITH {_TABLES} SELECT question_id, title, md5(body) AS body, score, accepted_answer_id,
  array_to_string(tags, '|') AS tags, view_count, creation_date FROM q""",
    "answer_csv_scan": f"WITH {_TABLES} SELECT question_id, answer_id, md5(body) AS body, score FROM a",
    "csv_pairs": f"""
WITH {_TABLES} SELECT question_id, title, md5(question_body) AS question_body, tags, score, view_count,
  md5(answer_body) AS answer_body, answer_score FROM pairs""",
    "acquisition_counts": f"""
WITH {_TABLES} SELECT (SELECT count(*) FROM q) AS questions_loaded, (SELECT count(*) FROM pairs) AS answers_matched""",
    "landed_questions": f"WITH {_LANDED_Q} SELECT question_id, accepted_answer_id, title, md5(body) AS body,"
                        " tags, score, view_count FROM lq",
    "landed_answers": f"WITH {_LANDED_A} SELECT answer_id, md5(body) AS body, score FROM la",
    "landed_pairs": f"""
WITH {_LANDED_Q}, {_LANDED_A}
SELECT question_id, {_plain('title')} AS title, md5({_plain('lq.body')}) AS question_body, tags, lq.score, view_count,
  md5({_plain('la.body')}) AS answer_body, la.score AS answer_score
FROM lq JOIN la ON lq.accepted_answer_id = la.answer_id""",
    "json_array_scan": f"""
WITH qa_base AS ({W.QA_BASE_SQL})
SELECT question_id, title, md5(question_body) AS question_body, lang || '|' || source AS tags, score, view_count,
  md5(answer_body) AS answer_body, answer_score FROM qa_base""",
    "csv_sink": W.with_qa(f"""
SELECT question_id, '["' || array_to_string(tags, '","') || '"]' AS tags,
  CASE WHEN len(error_signatures) = 0 THEN '[]'
       ELSE '["' || array_to_string(error_signatures, '","') || '"]' END AS error_signatures,
  '{{"char_count":' || length(question_body) || ',"word_count":' || {W.words('question_body')}
    || ',"sentence_count":' || {W.sentences('question_body')} || ',"code_block_count":'
    || {W.code_spans('question_body')} || '}}' AS question_metrics,
  md5(question_body) AS question_md5, md5(answer_body) AS answer_md5, quality_score FROM qa"""),
    "jsonl_sink": W.with_qa("""
SELECT question_id, quality_score, array_to_string(tags, '|') AS tags, md5(question_body) AS user_md5,
  md5(answer_body) AS assistant_md5 FROM qa"""),
    "source_fallback": W.with_qa("SELECT question_id, question_type, quality_score FROM qa"),
    "promoted_table": W.with_qa("SELECT question_id, complexity, quality_score FROM qa"),
}


def _report_oracle() -> str:
    from . import validate as V

    return f'SELECT ordinal, "check", "column", status, message FROM ({V.ORACLE["quality_checks"]})'


ORACLE["report_sink"] = _report_oracle()
# Read by split, the dumps give the same rows as read whole.
ORACLE["question_csv_split"] = ORACLE["question_csv_scan"]
ORACLE["answer_csv_split"] = ORACLE["answer_csv_scan"]
ORACLE["acquisition_counts_observed"] = ORACLE["acquisition_counts"]
ORACLE["json_document_split"] = ORACLE["json_array_scan"]
ORACLE["landed_question_documents"] = ORACLE["landed_questions"]

COVERS = {
    "question_csv_scan": ("S1", "P1", "P2", "F2", "F15"),
    "answer_csv_scan": ("S2", "P2", "P3", "W1", "F15"),
    "question_csv_split": ("S1", "P1", "P2", "F15"),
    "json_document_split": ("S3",),
    "landed_question_documents": ("S4", "P4"),
    "answer_csv_split": ("S2", "P2", "P3", "W1", "F15"),
    "csv_pairs": ("S1", "S2", "J1", "W1", "P9", "F1"),
    "acquisition_counts": ("A25",),
    "acquisition_counts_observed": ("A25", "S7"),
    "landed_questions": ("S4", "P4", "W2"),
    "landed_answers": ("S4", "W3"),
    "landed_pairs": ("S4", "J2", "W2", "W3", "P9"),
    "json_array_scan": ("S3",),
    "csv_sink": ("S9",),
    "jsonl_sink": ("S8", "T3"),
    "report_sink": ("S6", "S7", "S10"),
    "source_fallback": ("S5", "S7"),
    "promoted_table": ("S5", "S11"),
}
