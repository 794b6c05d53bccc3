"""Registered queries of the ``llm`` operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, op1_preference, op2_resync, op3_disclosure, op4_oph, op5_pack, op6_ecoc, op7_kneser_ney, op8_wu_manber, op9_taat, op10_mil, op11_fim, op12_merkle, op13_gam
from tidemark.sources.tables import read_table

WORD_BPE = "word_bpe_49k.json"


def op1_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against a rejected variant of itself (another ending, another course, a turn less, a role changed): lengths, masks and digests."""
    turns = op1_preference.pairs_from_conversations(read_table(spark, sf_dir, "conversations"))
    pairs = op1_preference.format_pairs(turns)
    trained = lambda c: F.aggregate(c, F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return pairs.select(
        "pair_id", "n_prefix", "n_chosen", "n_rejected", F.char_length("prompt").alias("prompt_chars"),
        F.md5("prompt").alias("prompt_md5"), F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"),
        trained("chosen_spans").alias("chosen_trained"), trained("rejected_spans").alias("rejected_trained"),
        op1_preference.listed("chosen_spans").alias("chosen_spans"), op1_preference.listed("rejected_spans").alias("rejected_spans"))


OP1_SQL = """
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, max(turn) over (partition by conv_id) as last, ((conv_id % 4) + 4) % 4 as kind
           from conversations where conv_id is not null),
donor as (select conv_id + 1 as conv_id, arg_max(text, (turn, role, text)) as other from c group by conv_id),
r as (select c.conv_id, turn, case when kind = 3 and turn = last then case role when 'assistant' then 'user' else 'assistant' end else role end as role,
             case when kind = 0 and turn = last and d.other is not null then d.other else text end as text
      from c left join donor d on d.conv_id = c.conv_id where kind <> 1 and not coalesce(kind = 2 and turn = last, false)
      union all select conv_id, turn, role, text from c where kind = 1 and (turn is null or turn < last // 2)
      union all select o.conv_id, c.turn, c.role, c.text from c join (select distinct conv_id, last // 2 as middle from c where kind = 1) o on o.conv_id = c.conv_id + 1 where c.turn >= o.middle),
sides as (select *, row_number() over (partition by conv_id, side order by turn nulls first, role, text) as i
          from (select conv_id, turn, role, text, 'chosen' as side from c union all select conv_id, turn, role, text, 'rejected' as side from r)),
n as (select conv_id, count(*) filter (where side = 'chosen') as nc, count(*) filter (where side = 'rejected') as nr from sides group by conv_id),
differ as (select a.conv_id, min(a.i) as i from sides a join sides b on a.conv_id = b.conv_id and a.i = b.i and a.side = 'chosen' and b.side = 'rejected'
           where a.role <> b.role or a.text <> b.text group by a.conv_id),
prefix as (select n.conv_id, nc, nr, coalesce(d.i - 1, least(nc, nr)) as n_prefix from n left join differ d on d.conv_id = n.conv_id),
said as (select s.conv_id, side, i, role, n_prefix, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as turn_text, length(role) + 5 as head, length(text) + 8 as body
         from sides s join prefix p on p.conv_id = s.conv_id),
placed as (select *, coalesce(sum(head + body) over (partition by conv_id, side order by i rows between unbounded preceding and 1 preceding), 0) as place from said where i > n_prefix),
done as (select conv_id, side, string_agg(turn_text, '' order by i) as body_text, sum(case when role = 'assistant' then body else 0 end) as trained,
                string_agg(case when role = 'assistant' then (place + head)::bigint || ':' || (place + head + body)::bigint end, ',' order by i) as spans from placed group by conv_id, side),
prompts as (select conv_id, string_agg(turn_text, '' order by i) as prompt from said where side = 'chosen' and i <= n_prefix group by conv_id)
select p.conv_id as pair_id, n_prefix::int as n_prefix, (nc - n_prefix)::int as n_chosen, (nr - n_prefix)::int as n_rejected, length(coalesce(prompt, ''))::int as prompt_chars,
  md5(coalesce(prompt, '')) as prompt_md5, md5(coalesce(a.body_text, '')) as chosen_md5, md5(coalesce(b.body_text, '')) as rejected_md5,
  coalesce(a.trained, 0)::int as chosen_trained, coalesce(b.trained, 0)::int as rejected_trained, coalesce(a.spans, '') as chosen_spans, coalesce(b.spans, '') as rejected_spans
from prefix p left join prompts using (conv_id) left join done a on a.conv_id = p.conv_id and a.side = 'chosen' left join done b on b.conv_id = p.conv_id and b.side = 'rejected'
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document, huge ones by overlapping chunks."""
    counts = op2_resync.count_tokens(common.documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op3_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it in every document."""
    found = op3_disclosure.sanitise(common.documents(spark, sf_dir))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("rest.doc_id", *[n(k) for k in op3_disclosure.KINDS], F.sha2(op3_disclosure.listed("base"), 256).alias("base_sha256"),
                        op3_disclosure.listed("spans").alias("spans"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share at least three quarters of their 5-word shingles."""
    return op4_oph.near_duplicates(common.documents(spark, sf_dir))


OP4_SQL = r"""
with recursive w as (select doc_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+', ' ', 'g'), ' '), ' ') as words from documents),
s as (select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
      from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from w where words <> ['']) ),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)),
edges as (select a, b from links union all select b, a from links),
reach as (select doc_id, doc_id as root from documents union select e.b, r.root from reach r join edges e on e.a = r.doc_id where r.root < e.b)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, min(root) as component_id, d.doc_id = min(root) as kept
from documents d join reach r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id, n
"""


def op5_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return op5_pack.pack(common.documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), with_ids=False)


def op6_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the folds 1 to 4."""
    docs = common.documents(spark, sf_dir)
    fold = common.crc_mod("doc_id", 5)
    found = op6_ecoc.identify(docs, op6_ecoc.train(docs.where(fold != 0)))
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op7_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents under a model of those outside of fold 2."""
    docs = common.documents(spark, sf_dir)
    fold = common.crc_mod("doc_id", 7)
    found = op7_kneser_ney.score(docs, op7_kneser_ney.train(docs.where(fold != 2)))
    return found.select("doc_id", (fold == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def contamination(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of the contract from what ``find_windows`` gives."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select(
        id_col, "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows of the benchmark in every document."""
    return contamination(op8_wu_manber.find_windows(common.documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")))


OP8_SQL = r"""
with w as (select doc_id, row_number() over () as row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
p as (select distinct item_id, least(13, len(words)) as m, array_to_string(words[i:i + least(13, len(words)) - 1], ' ') as pattern
      from (select item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as i from b where len(words) > 0)),
lengths as (select distinct m from p),
g as (select row, m, i, array_to_string(words[i:i + m - 1], ' ') as pattern
      from (select row, words, m, unnest(range(1, len(words) - m + 2)) as i from w, lengths where len(words) >= m)),
f as (select g.row, g.i, g.m, p.item_id from g join p on g.m = p.m and g.pattern = p.pattern),
hits as (select row, count(distinct k) as n_hit from (select row, unnest(range(i, i + m)) as k from f) group by row),
found as (select row, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items from (select distinct row, item_id from f) group by row)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from w left join hits on w.row = hits.row left join found on w.row = found.row
"""


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for each row whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return op9_taat.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


OP9_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank, vec_id, score
from (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from s) where rank <= 5
"""

def op10_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside of fold 2."""
    docs = common.documents(spark, sf_dir)
    fold = common.crc_mod("doc_id", 4)
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    model = op10_mil.train(docs.where(fold != 2), labels.where(fold != 2))
    found = op10_mil.score(docs, model)
    return found.select("doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as prefix, suffix and middle of its lines, and the text that its output gives back."""
    found = op11_fim.transform(common.documents(spark, sf_dir), with_text=False)
    return found.drop("output")


OP11_SQL = r"""
with h as (select coalesce(text, '') as text, doc_id, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
u as (select *, case when text = '' then [] else regexp_extract_all(text, '[^\n]*\n|[^\n]+') end as units,
      ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from h),
c as (select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b,
      case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from u),
p as (select *, coalesce(array_to_string(units[1:a], ''), '') as prefix, coalesce(array_to_string(units[a + 1:b], ''), '') as middle, coalesce(array_to_string(units[b + 1:n], ''), '') as suffix from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars, case when form <> 'plain' then length(middle) end::bigint as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256 from p
"""

MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the dataset's Merkle tree, and whether its row, tampered with where 3 divides its id's crc32, still leads to the root."""
    docs = read_table(spark, sf_dir, "documents", MANIFEST_COLUMNS)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.coalesce(common.crc_mod("doc_id", 3) == 0, F.lit(False))
    shown = op12_merkle.leaf(docs, MANIFEST_COLUMNS, {"text": F.when(tampered, lowered).otherwise(F.col("text"))})
    found = op12_merkle.manifest(docs, MANIFEST_COLUMNS, carried={"shown": shown}).proofs()
    folded = found.withColumn("folded_root", op12_merkle.fold(F.col("shown"), F.col("proof")))
    return folded.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(op12_merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _op12_sql(levels: int = 9, over: int = 4) -> str:
    """The manifest level by level: up to 8 ** levels rows a language, 8 ** over languages."""
    enc = lambda c, text=None: f"coalesce(strlen({text or f'{c}::varchar'}) || ':' || {text or f'{c}::varchar'}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(enc(c, text if c == "text" else None) for c in MANIFEST_COLUMNS) + ")"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: {bits}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""l as (select doc_id, coalesce('=' || lang, '-') as tree, {leaf('text')} as leaf, case when {crc} % 3 = 0 then {leaf(lower)} else {leaf('text')} end as shown from documents)""",
             "r as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, row_number() over () as row from l)"]

    def tree(name: str, first: str, levels: int) -> None:
        parts.append(f"{name}0 as ({first})")
        for k in range(levels):
            parts.append(f"{name}g{k} as (select tree, i // 8 as i, list(digest order by i) as ds, max(n) as n from {name}{k} group by all)")
            parts.append(f"{name}{k + 1} as (select tree, i, case when n = 1 then ds[1] else sha256(array_to_string(ds, '')) end as digest, (n + 7) // 8 as n from {name}g{k})")

    def climb(name: str, rows: str, out: str, levels: int) -> None:
        """rows: (row, tree, i, folded, sides); i is the rank in the tree."""
        parts.append(f"{out}0 as ({rows})")
        for k in range(levels):
            inside = f"(x.i // {8 ** k}) % 8"
            left, right = f"coalesce(array_to_string(g.ds[1:{inside}], ''), '')", f"coalesce(array_to_string(g.ds[{inside} + 2:8], ''), '')"
            parts.append(f"""{out}{k + 1} as (select row, x.tree, x.i, case when g.n = 1 then folded else sha256({left} || folded || {right}) end as folded,
                case when g.n = 1 then sides else sides || {left} || {right} end as sides from {out}{k} x join {name}g{k} g on g.tree = x.tree and g.i = x.i // {8 ** (k + 1)})""")

    tree("t", "select tree, i, leaf as digest, count(*) over (partition by tree) as n from r", levels)
    parts.append(f"s as (select tree as lang, digest, row_number() over (order by tree) - 1 as i from t{levels})")
    tree("o", "select '' as tree, i, digest, count(*) over () as n from s", over)
    climb("t", "select row, tree, i, shown as folded, '' as sides from r", "c", levels)
    climb("o", f"select row, '' as tree, s.i, folded, sides from c{levels} c join s on s.lang = c.tree", "d", over)
    return "with " + ",\n".join(parts) + f"""
select r.doc_id, r.leaf, s.digest as subroot, o.digest as root, sha256(d.sides) as proof_sha256, d.folded as folded_root, d.folded = o.digest as verified
from r join d{over} d on d.row = r.row join s on s.lang = r.tree, o{over} o
"""


def op13_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from labels outside of fold 0."""
    docs = common.documents(spark, sf_dir)
    fold = common.crc_mod("doc_id", 5)
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    found = op13_gam.score(docs, op13_gam.train(docs.where(fold != 0), labels.where(fold != 0)))
    return found.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "reasons")


QUERIES = {f.__name__: f for f in (op1_preference_formatting, op2_token_counts, op3_disclosure_sanitisation, op4_near_duplicates, op5_packed_sequences,
                                  op6_language_codes, op7_kneser_ney_scores, op8_decontamination, op9_exact_top_k, op10_toxic_sentences, op11_fill_in_middle, op12_merkle_manifest,
                                  op13_quality_scores)}
SQL = {"op1_preference_formatting": OP1_SQL, "op4_near_duplicates": OP4_SQL, "op8_decontamination": OP8_SQL, "op9_exact_top_k": OP9_SQL,
       "op11_fill_in_middle": OP11_SQL, "op12_merkle_manifest": _op12_sql()}
