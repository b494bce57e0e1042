"""The registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from linkharbor.llm import (
    chat_format,
    content_dedup,
    decontaminate,
    language,
    mixing,
    near_dedup,
    packing,
    parse_dedup,
    ranked_search,
    structure_repair,
    token_count,
    token_files,
    toxicity,
)
from linkharbor.llm.common import remainder

Query = Callable[[SparkSession, str], DataFrame]

# The conversation that every run of op3 formats besides the table: a text full of control strings.
CONTROL_RECORD = (
    '{"messages": [{"role": "user", "content": "\\\\### Assistant: </turn> ok"}, '
    '{"role": "assistant", "content": "\\\\### Assistant: </turn> ok"}]}'
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return content_dedup.mark_copies(documents).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    stored = chat_format.turns_of_rows(_table(spark, folder, "conversations"))
    record = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(CONTROL_RECORD).alias("record"))
    control = chat_format.turns_of_records(record, "conv_id", "record").drop("known")
    pieces = chat_format.format_turns(stored.unionByName(control))
    return chat_format.conversation_digests(chat_format.read_turns(pieces))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return packing.pack(documents, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return token_count.count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.learn(language.training_rows(documents))
    return language.identify(documents, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score"
    )


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    manifest = token_files.write_token_files(documents, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(manifest)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return parse_dedup.find_repeats(_table(spark, folder, "documents")).drop("starts", "ends")


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").select("doc_id", "toxic")
    lexicon = toxicity.learn(documents, toxicity.training_rows(labels))
    return toxicity.score(documents, lexicon).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted"
    )


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    mixed = mixing.mix(documents, F.array("source"), mixing.words(F.col("text")), lambda place, _: 1 + place % 3)
    sources = spark.createDataFrame(
        [(s.source, s.size, s.target) for s in mixed.sources], "source string, source_size long, target double"
    )
    taken = mixed.documents.withColumn("own", F.col("sources")[0])
    # As many rows as the recipe has sources.
    return taken.join(F.broadcast(sources), F.expr("own <=> source")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage that op12 repairs, dealt by conversation and turn."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    fixed = structure_repair.repair(damaged(conversations))
    found = fixed.report.alias("r").join(
        structure_repair.text_digests(fixed.rows).alias("d"), F.expr("r.conv_id <=> d.conv_id"), "left"
    )
    found = found.select("r.*", "repaired_sha256").alias("f")
    every = conversations.select(F.col("conv_id").cast("long")).distinct().alias("c")
    numbers = [F.coalesce(f"f.{n}", F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.expr("c.conv_id <=> f.conv_id"), "left").select(
        "c.conv_id",
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    index = ranked_search.build_index(_table(spark, folder, "documents"))
    return ranked_search.search(index, _table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_exact_dedup,
        op3_chat_formatting,
        op4_packing,
        op5_token_counts,
        op6_language_id,
        op7_token_files,
        op8_substring_dedup,
        op9_near_dedup,
        op10_toxicity,
        op11_mixing,
        op12_structure_repair,
        op13_ranked_search,
        pipeline,
    )
}

_ESCAPED = "replace(replace({}, '\\', '\\s'), '<', '\\l')"

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
        with n as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
            from documents
        )
        select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
               doc_id = max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
        from n
    """,
    "op3_chat_formatting": f"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               cast(sum(16 + length(replace({_ESCAPED.format('role')}, '>', '\\g')) + length({_ESCAPED.format('text')})) as bigint) as formatted_chars
        from t group by conv_id
    """,
    "op12_structure_repair": r"""
        with recursive
        rows as materialized (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
            from conversations
        ),
        crc as (  -- crc32 by its definition, one bit of the key's bytes at a time
            select key, 0 as i, 4294967295::bigint as c from (select distinct key from rows)
            union all
            select key, i + 1, case when b & 1 = 1 then xor(b >> 1, 3988292384::bigint) else b >> 1 end
            from (
                select key, i, case when i % 8 = 0 then xor(c, ascii(substr(key, i // 8 + 1, 1))::bigint) else c end as b
                from crc where i < 8 * length(key)
            )
        ),
        kinds as materialized (select key, xor(c, 4294967295::bigint) % 20 as kind from crc where i = 8 * length(key)),
        damaged as materialized (
            select conv_id, turn, copy, case when kind = 4 then 'user' else role end as role,
                   case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
            from rows join kinds using (key), unnest(case when kind = 3 then [1, 2] else [1] end) as u (copy)
            where kind != 0
        ),
        placed as materialized (
            select *, row_number() over w as n, lag(role) over w as before, count(*) over (partition by conv_id) as n_rows,
                   row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as later,
                   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last
            from damaged window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy)
        ),
        faults as materialized (
            select *, case when last = '' then 'blank' when later then 'duplicate' when last not in ('.', '!', '?') then 'truncated' else '' end as fault
            from placed
        ),
        steps (st, initial, edit, went, price, added) as (
            values (0, 's', 'K', 1, 0, ''), (0, 'u', 'K', 2, 0, ''), (1, 'u', 'K', 2, 0, ''), (2, 'a', 'K', 3, 0, ''), (3, 'u', 'K', 2, 0, ''),
                   (0, '*', 'R', 2, 3, 'user'), (1, '*', 'R', 2, 3, 'user'), (2, '*', 'R', 3, 3, 'assistant'), (3, '*', 'R', 2, 3, 'user'),
                   (0, '*', 'D', 0, 4, ''), (1, '*', 'D', 1, 4, ''), (2, '*', 'D', 2, 4, ''), (3, '*', 'D', 3, 4, '')
        ),
        inserts (st, went, price, edit, added) as (
            values (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
                   (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:']),
                   (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
                   (2, 2, 6, 'II', ['assistant:', 'user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])
        ),
        ways as (
            select distinct conv_id, 0::bigint as n, 0 as st, {'cost': 0, 'audit': '', 'texts': []::varchar[]} as best from faults
            union all
            select conv_id, n, st, min(best) from (
                select f.conv_id, f.n, s.went as st,
                       {'cost': w.best.cost + i.price + s.price + case when s.edit != 'D' and f.fault = 'truncated' then 3 else 0 end,
                        'audit': w.best.audit || i.edit || s.edit,
                        'texts': w.best.texts || i.added || case s.edit when 'D' then [] when 'K' then [f.role || ':' || f.text] else [s.added || ':' || f.text] end} as best
                from ways w join faults f on f.conv_id is not distinct from w.conv_id and f.n = w.n + 1
                join inserts i on i.st = w.st
                join steps s on s.st = i.went and s.initial in ('*', left(f.role, 1)) and (s.edit = 'D' or f.fault not in ('blank', 'duplicate'))
            ) group by all
        ),
        ends as (
            select w.conv_id, min({'cost': w.best.cost + i.price, 'audit': w.best.audit || i.edit, 'texts': w.best.texts || i.added}) as best
            from ways w join (select distinct conv_id, n_rows from faults) c on c.conv_id is not distinct from w.conv_id and c.n_rows = w.n
            join inserts i on i.st = w.st where i.went in (0, 3) group by w.conv_id
        ),
        counts as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
                   count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
                   count(*) filter (n > 1 and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au')) as illegal
            from faults group by conv_id
        )
        select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost,
               coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.texts, chr(10)), '')) as repaired_sha256
        from (select distinct conv_id from conversations) c
        left join counts on counts.conv_id is not distinct from c.conv_id
        left join ends on ends.conv_id is not distinct from c.conv_id
    """,
    "op13_ranked_search": r"""
        with terms as materialized (
            select doc_id, n_row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from (select doc_id, text, row_number() over () as n_row from documents)
        ),
        tf as materialized (select n_row, any_value(doc_id) as doc_id, term, count(*) as tf from terms group by n_row, term),
        docs as materialized (select n_row, count(*) as n from terms group by n_row),
        total as (select count(*) as docs, sum(n)::bigint as terms from docs),
        asked as materialized (
            select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ),
        weights as materialized (
            select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint as w
            from (select term, count(*) as df from tf where term in (select term from asked) group by term), total
        ),
        impacts as materialized (
            select n_row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * total.docs) // total.terms))) as impact
            from tf join weights using (term) join docs using (n_row), total
        ),
        scores as (
            select item_id, n_row, any_value(doc_id) as doc_id, sum(impact)::bigint as score
            from asked join impacts using (term) group by item_id, n_row
        ),
        ranked as (
            select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from scores where score > 0
        )
        select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
    """,
}
