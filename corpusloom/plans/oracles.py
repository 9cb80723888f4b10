"""The same queries as SQL over the same tables, for an independent engine."""

from __future__ import annotations

_DOCS = r"""
docs AS (
  SELECT doc_id, text, n_chars,
         CASE WHEN h < 8 THEN 'train' WHEN h = 8 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 2))::INT % 10 AS h FROM documents)
)"""
_FULL = r"""
full_docs AS (
  SELECT * FROM docs WHERE length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 0
)"""
_TOKS = _DOCS + "," + _FULL + r""",
toks AS (SELECT doc_id, split, regexp_extract_all(text, '\S+') AS tokens FROM full_docs)"""
_LOWER = _DOCS + "," + _FULL + r""",
toks AS (SELECT doc_id, split, regexp_extract_all(lower(text), '\S+') AS tokens FROM full_docs)"""
_VOCABULARY = _LOWER + r""",
vocabulary AS (
  SELECT token, (row_number() OVER (ORDER BY freq DESC, token) + 1)::INT AS id, freq
  FROM (SELECT token, count(*) AS freq FROM (SELECT unnest(tokens) AS token FROM toks)
        GROUP BY token ORDER BY freq DESC, token LIMIT 4998)
)"""
_IDS = _VOCABULARY + r""",
placed AS (
  SELECT doc_id, split, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM toks
),
ids AS (
  SELECT p.doc_id, p.split, p.pos, p.token, coalesce(v.id, 1) AS id
  FROM placed p LEFT JOIN vocabulary v ON p.token = v.token
)"""
_LISTS = _IDS + r""",
lists AS (SELECT doc_id, split, list(id ORDER BY pos) AS ids FROM ids GROUP BY doc_id, split)"""
_WINDOWS = r""",
starts AS (
  SELECT split, n, unnest(range(0, n, 512)) AS b
  FROM (SELECT split, sum(len(tokens))::BIGINT AS n FROM toks GROUP BY split)
),
ends AS (SELECT split, n, b, least(b + 2048, n) AS e FROM starts),
plan AS (
  SELECT split, n, b, e, coalesce(lag(e) OVER (PARTITION BY split ORDER BY b), 0) AS p FROM ends
),
kept AS (SELECT * FROM plan WHERE p < n)"""
_PAIRS = _LOWER + r""",
flat AS (
  SELECT doc_id, split, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM toks
),
neighbours AS (
  SELECT doc_id, split, token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS next_token FROM flat
),
pairs AS (SELECT * FROM neighbours WHERE next_token IS NOT NULL),
model AS (
  SELECT token, next_token, count(*)::BIGINT AS n FROM pairs WHERE split = 'train' GROUP BY token, next_token
),
contexts AS (SELECT token, sum(n)::BIGINT AS n FROM model GROUP BY token),
targets AS (SELECT next_token, sum(n)::BIGINT AS n FROM model GROUP BY next_token),
sizes AS (SELECT count(*) + 1 AS v, sum(n)::BIGINT AS total FROM targets)"""
_SCORES = _PAIRS + r""",
scored AS (
  SELECT p.split,
         -ln((coalesce(m.n, 0) + 1.0::DOUBLE) / (coalesce(c.n, 0) + s.v)) AS nll,
         -ln((coalesce(t.n, 0) + 1.0::DOUBLE) / (s.total + s.v)) AS base_nll
  FROM pairs p
  LEFT JOIN model m ON p.token = m.token AND p.next_token = m.next_token
  LEFT JOIN contexts c ON p.token = c.token
  LEFT JOIN targets t ON p.next_token = t.next_token
  CROSS JOIN sizes s
  WHERE p.split <> 'train'
),
scores AS (
  SELECT split, count(*) AS n_pairs, avg(nll) AS loss, exp(avg(nll)) AS perplexity,
         exp(avg(base_nll)) AS baseline
  FROM scored GROUP BY split
)"""
_RUNS = r"""
runs AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
         value AS eval_loss
  FROM events
)"""
_TIMED = r"""
timed AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, value AS loss, ts
  FROM events
)"""
_EPOCHS = _DOCS + r""",
epochs AS (
  SELECT e.epoch, d.doc_id,
         row_number() OVER (PARTITION BY e.epoch ORDER BY md5('42:' || e.epoch || ':' || d.doc_id), d.doc_id) - 1
           AS position
  FROM (SELECT unnest([0, 1])::INT AS epoch) e CROSS JOIN (SELECT doc_id FROM docs WHERE split = 'train') d
)"""
_BLOCK_VALUES = r"""
  count(*)::INT AS n_tokens, md5(string_agg(id::VARCHAR, ' ' ORDER BY spot)) AS ids_md5,
  md5(string_agg(id::VARCHAR, ' ' ORDER BY spot)) AS labels_md5"""


def _draw(tag: str) -> str:
    return f"('0x' || substr(md5('{tag}:42:' || doc_id || ':' || pos), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE"


ORACLES: dict[str, str] = {
    "scan_split_counts": f"WITH {_DOCS} SELECT split, count(*) AS num_rows FROM docs GROUP BY split",
    "named_split_scan": f"WITH {_DOCS} SELECT doc_id, n_chars FROM docs WHERE split = 'validation'",
    "split_alias": f"""WITH {_DOCS}, aliased AS (
          SELECT split FROM docs WHERE split <> 'test'
          UNION ALL SELECT 'test' FROM docs WHERE split = 'validation')
        SELECT split, count(*) AS num_rows FROM aliased GROUP BY split""",
    "nonblank_documents": f"WITH {_DOCS}, {_FULL} SELECT doc_id, md5(text) AS text_md5 FROM full_docs",
    "mapped_token_counts": r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS n_tokens FROM documents",
    "head_subset": "SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY doc_id LIMIT 100",
    "head_per_split": f"""WITH {_DOCS} SELECT split, doc_id FROM docs
        QUALIFY row_number() OVER (PARTITION BY split ORDER BY doc_id) <= 20""",
    "subset_report": "SELECT count(*) AS original_rows, least(count(*), 100)::BIGINT AS subset_rows FROM documents",
    "runlog_interval": f"WITH {_RUNS} SELECT run_id, step, eval_loss FROM runs WHERE step % 5 = 0",
    "vocabulary_topk": f"WITH {_VOCABULARY} SELECT token, id, freq FROM vocabulary",
    "tokenize_truncate": f"""WITH {_LISTS}
        SELECT doc_id, least(len(ids), 512)::INT AS n_tokens, md5(array_to_string(ids[1:512], ' ')) AS ids_md5
        FROM lists""",
    "decode_preview": f"""WITH {_IDS}
        SELECT doc_id,
               substr(string_agg(CASE WHEN id = 1 THEN '<unknown>' ELSE token END, ' ' ORDER BY pos), 1, 200) AS preview
        FROM ids WHERE pos < 100 GROUP BY doc_id""",
    "sentence_count": r"""SELECT doc_id, len(list_filter(string_split_regex(text, '[.!?]+'),
            lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) > 10))::BIGINT AS n_sentences
        FROM documents""",
    "corpus_positions": f"""WITH {_TOKS} SELECT doc_id,
            row_number() OVER (ORDER BY doc_id) - 1 AS row_index,
            coalesce(sum(len(tokens)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
              AS token_start
        FROM toks""",
    "turn_positions": r"""WITH turns AS (
          SELECT conv_id, turn, len(regexp_extract_all(text, '\S+')) AS n FROM conversations
          WHERE length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 0)
        SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_index,
            coalesce(sum(n) OVER (ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
              AS token_start
        FROM turns""",
    "pack_blocks": f"""WITH {_IDS}, numbered AS (
          SELECT doc_id, (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // 100 AS batch FROM full_docs),
        at_batch AS (
          SELECT i.split, n.batch, i.id,
                 row_number() OVER (PARTITION BY i.split, n.batch ORDER BY i.doc_id, i.pos) - 1 AS spot,
                 count(*) OVER (PARTITION BY i.split, n.batch) AS total
          FROM ids i JOIN numbered n USING (doc_id))
        SELECT split, batch, spot // 512 AS block, {_BLOCK_VALUES}
        FROM at_batch WHERE total < 512 OR spot < total - total % 512 GROUP BY split, batch, spot // 512""",
    "pack_split_blocks": f"""WITH {_IDS}, at_split AS (
          SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS spot,
                 count(*) OVER (PARTITION BY split) AS total FROM ids)
        SELECT split, spot // 512 AS block, {_BLOCK_VALUES}
        FROM at_split WHERE total < 512 OR spot < total - total % 512 GROUP BY split, spot // 512""",
    "collate_padded": f"""WITH {_LISTS}, numbered AS (
          SELECT doc_id, split, ids, (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // 4 AS batch_id
          FROM lists),
        wide AS (
          SELECT *, (ceil(max(len(ids)) OVER (PARTITION BY split, batch_id) / 8.0) * 8)::INT AS width FROM numbered)
        SELECT split, batch_id, doc_id, width, (width - len(ids))::INT AS n_pad,
               md5(array_to_string(list_resize(ids, width, 0), ' ')) AS ids_md5,
               md5(array_to_string(list_resize(list_transform(ids, lambda x: 1), width, 0), ' ')) AS mask_md5,
               md5(array_to_string(list_transform(list_resize(ids, width, 0),
                   lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ' ')) AS labels_md5
        FROM wide""",
    "mask_tokens": f"""WITH {_IDS}, drawn AS (
          SELECT doc_id, pos, id, {_draw('select')} < 0.15 AS chosen, {_draw('change')} AS change,
                 floor({_draw('word')} * 5000)::INT AS word FROM ids),
        kinds AS (
          SELECT *, CASE WHEN NOT chosen THEN 'keep' WHEN change < 0.8 THEN 'mask'
                         WHEN change < 0.9 THEN 'random' ELSE 'same' END AS kind FROM drawn)
        SELECT doc_id,
               count(*) FILTER (kind <> 'keep')::INT AS n_selected, count(*) FILTER (kind = 'mask')::INT AS n_mask,
               count(*) FILTER (kind = 'random')::INT AS n_random, count(*) FILTER (kind = 'same')::INT AS n_keep,
               md5(string_agg((CASE kind WHEN 'mask' THEN 5000 WHEN 'random' THEN word ELSE id END)::VARCHAR,
                   ' ' ORDER BY pos)) AS ids_md5,
               md5(string_agg((CASE kind WHEN 'keep' THEN -100 ELSE id END)::VARCHAR, ' ' ORDER BY pos)) AS labels_md5
        FROM kinds GROUP BY doc_id""",
    "sliding_windows": f"""WITH {_TOKS} {_WINDOWS}
        SELECT split, b AS "begin", e AS "end", e - p AS trg_len FROM kept""",
    "window_targets": f"""WITH {_TOKS} {_WINDOWS}
        SELECT split, b // 512 AS "window", p AS first_target, e - 1 AS last_target, e - p AS n_targets FROM kept""",
    "split_metrics": f"""WITH {_TOKS}, cut AS (SELECT split, len(tokens) AS n FROM toks)
        SELECT split, count(*) AS num_examples, round(avg(n), 6) AS avg_seq_length,
               min(n)::BIGINT AS min_seq_length, max(n)::BIGINT AS max_seq_length, sum(n)::BIGINT AS total_tokens
        FROM cut GROUP BY split""",
    "head_statistics": f"""WITH {_TOKS}, ranked AS (
          SELECT split, len(tokens) AS n, substr(array_to_string(tokens[1:100], ' '), 1, 200) AS shown,
                 row_number() OVER (PARTITION BY split ORDER BY doc_id) AS r FROM toks)
        SELECT split, count(*) AS num_examples, round(avg(n) FILTER (r <= 100), 6) AS avg_length_100,
               (max(n) FILTER (r = 1))::BIGINT AS first_length, max(shown) FILTER (r = 1) AS preview
        FROM ranked GROUP BY split""",
    "sentence_estimate": "WITH" + _DOCS + r""", sample AS (
          SELECT text FROM docs WHERE split = 'train' ORDER BY doc_id LIMIT 500),
        counted AS (
          SELECT len(list_filter(string_split_regex(text, '[.!?]+'),
                     lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) > 10)) AS n FROM sample),
        sums AS (SELECT count(*) AS k, sum(n)::BIGINT AS s FROM counted)
        SELECT k AS sample_size, s AS sentences, round(s / k, 6) AS avg_per_example, total AS total_examples,
               round(s / k * total, 6) AS estimated_total
        FROM sums CROSS JOIN (SELECT count(*) AS total FROM docs WHERE split = 'train')""",
    "window_perplexity": f"""WITH {_PAIRS} {_WINDOWS}, sequence AS (
          SELECT split, token, lag(token) OVER (PARTITION BY split ORDER BY doc_id, pos) AS before,
                 row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS spot
          FROM flat WHERE split <> 'train'),
        losses AS (
          SELECT q.split, k.b, k.e - k.p AS trg_len,
                 -ln((coalesce(m.n, 0) + 1.0::DOUBLE) / (coalesce(c.n, 0) + s.v)) AS nll
          FROM sequence q
          JOIN kept k ON q.split = k.split AND q.spot >= k.p AND q.spot < k.e
          LEFT JOIN model m ON q.before = m.token AND q.token = m.next_token
          LEFT JOIN contexts c ON q.before = c.token
          CROSS JOIN sizes s
          WHERE q.before IS NOT NULL),
        means AS (SELECT split, b, trg_len, avg(nll) AS mean FROM losses GROUP BY split, b, trg_len)
        SELECT split, sum(trg_len)::BIGINT AS n_tokens, round(exp(sum(mean * trg_len) / sum(trg_len)), 4) AS perplexity
        FROM means GROUP BY split""",
    "file_order_positions": r"""WITH rows AS (
          SELECT row_number() OVER () - 1 AS row_index, text, len(regexp_extract_all(text, '\S+')) AS n FROM documents)
        SELECT row_index, md5(text) AS text_md5,
               coalesce(sum(n) OVER (ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
                 AS token_start
        FROM rows""",
    "batch_plan_capped": f"""WITH {_DOCS}, total AS (
          SELECT count(*) AS n, ceil(ceil(count(*) / 8.0) / 8.0)::BIGINT AS steps FROM docs WHERE split = 'train'),
        series AS (SELECT unnest(range(0, ceil(40.0 / steps)::BIGINT))::INT AS epoch FROM total),
        epochs AS (
          SELECT e.epoch, d.doc_id,
                 row_number() OVER (PARTITION BY e.epoch ORDER BY md5('42:' || e.epoch || ':' || d.doc_id), d.doc_id) - 1
                   AS position
          FROM series e CROSS JOIN (SELECT doc_id FROM docs WHERE split = 'train') d)
        SELECT epoch, doc_id, position // 8 AS micro_batch, (position // 4 % 2)::INT AS rank,
               (epoch * steps + position // 64)::BIGINT AS opt_step
        FROM epochs CROSS JOIN total WHERE epoch * steps + position // 64 < 40""",
    "next_token_candidates_sharp": f"""WITH {_PAIRS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY token ORDER BY n DESC, next_token) AS rank,
                 pow(n / max(n) OVER (PARTITION BY token)::DOUBLE, 20) AS w FROM model),
        summed AS (
          SELECT *, sum(w) OVER (PARTITION BY token) AS s,
                 sum(w) OVER (PARTITION BY token ORDER BY rank ROWS UNBOUNDED PRECEDING) AS upto
          FROM ranked WHERE rank <= 50)
        SELECT token, next_token, rank::INT AS rank, round(w / s, 6) AS p, round(upto / s, 6) AS cum_p
        FROM summed WHERE rank = 1 OR round((upto - w) / s, 12) < 0.95""",
    "epoch_shuffle": f"WITH {_EPOCHS} SELECT epoch, position, doc_id FROM epochs",
    "batch_plan": f"""WITH {_EPOCHS}, total AS (SELECT count(*) AS n FROM docs WHERE split = 'train')
        SELECT epoch, doc_id, position // 8 AS micro_batch, (position // 4 % 2)::INT AS rank,
               (epoch * ceil(ceil(n / 8.0) / 8.0) + position // 64)::BIGINT AS opt_step
        FROM epochs CROSS JOIN total""",
    "step_totals": f"""WITH {_DOCS}, m AS (
          SELECT ceil(count(*) / 8.0)::BIGINT AS micro_batches FROM docs WHERE split = 'train')
        SELECT 64::BIGINT AS effective_batch, micro_batches, ceil(micro_batches / 8.0)::BIGINT AS steps_per_epoch,
               (2 * ceil(micro_batches / 8.0))::BIGINT AS total_steps FROM m""",
    "bigram_counts": f"WITH {_PAIRS} SELECT token, next_token, n FROM model",
    "bigram_perplexity": f"""WITH {_SCORES}
        SELECT CASE split WHEN 'validation' THEN 'eval' ELSE split END || '_perplexity' AS metric, n_pairs,
               round(perplexity, 4) AS perplexity FROM scores""",
    "baseline_comparison": f"""WITH {_SCORES}
        SELECT split, round(perplexity, 4) AS perplexity, round(baseline, 4) AS baseline,
               round(perplexity - baseline, 4) AS difference,
               round((1 - perplexity / baseline) * 100, 4) AS relative_improvement FROM scores""",
    "next_token_candidates": f"""WITH {_PAIRS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY token ORDER BY n DESC, next_token) AS rank FROM model),
        summed AS (
          SELECT *, sum(n) OVER (PARTITION BY token)::DOUBLE AS s,
                 sum(n) OVER (PARTITION BY token ORDER BY rank ROWS UNBOUNDED PRECEDING)::DOUBLE AS upto
          FROM ranked WHERE rank <= 50)
        SELECT token, next_token, rank::INT AS rank, round(n / s, 6) AS p, round(upto / s, 6) AS cum_p
        FROM summed WHERE rank = 1 OR (upto - n) / s < 0.95""",
    "runlog_perplexity": f"""WITH {_RUNS}
        SELECT run_id, step, eval_loss,
               CASE WHEN eval_loss <> 0 THEN format('{{:.6e}}', exp(eval_loss))::DOUBLE END AS eval_perplexity
        FROM runs""",
    "final_metrics": f"""WITH {_SCORES}, named AS (
          SELECT CASE split WHEN 'validation' THEN 'eval' ELSE split END AS prefix, loss, perplexity FROM scores)
        SELECT prefix || '_loss' AS metric, round(loss, 4) AS value FROM named
        UNION ALL SELECT prefix || '_perplexity', round(perplexity, 4) FROM named""",
    "lr_schedule": f"""WITH {_RUNS}, steps AS (
          SELECT run_id, step, max(step) OVER (PARTITION BY run_id) AS total FROM runs)
        SELECT run_id, step, round(0.0005::DOUBLE * CASE WHEN step < 10 THEN step / 10.0::DOUBLE
            ELSE greatest(0.0, 0.5 * (1 + cos(pi() * ((step - 10) / greatest(1, total - 10)::DOUBLE)))) END, 10)
            AS learning_rate
        FROM steps""",
    "best_checkpoint": f"""WITH {_RUNS} SELECT run_id, step, eval_loss FROM runs
        QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1""",
    "early_stop": f"""WITH {_RUNS}, bests AS (
          SELECT *, min(eval_loss) OVER (PARTITION BY run_id ORDER BY step
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM runs),
        islands AS (
          SELECT *, sum(CASE WHEN best IS NULL OR eval_loss < best THEN 1 ELSE 0 END)
              OVER (PARTITION BY run_id ORDER BY step) AS island FROM bests),
        waits AS (
          SELECT *, row_number() OVER (PARTITION BY run_id, island ORDER BY step) - 1 AS waited FROM islands)
        SELECT run_id, min(step) FILTER (waited >= 5) AS stop_step FROM waits GROUP BY run_id""",
    "checkpoint_retention": f"""WITH {_RUNS}, saved AS (
          SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1 AS is_best
          FROM runs WHERE step % 10 = 0)
        SELECT run_id, step, is_best FROM saved
        QUALIFY is_best OR row_number() OVER (PARTITION BY run_id, is_best ORDER BY step DESC) <= 2""",
    "last_checkpoint": f"""WITH {_RUNS}
        SELECT run_id, max(step) FILTER (step % 10 = 0) AS step FROM runs GROUP BY run_id""",
    "event_cadence": f"""WITH {_RUNS}
        SELECT run_id, step, step % 5 = 0 OR step = 1 AS logs, step % 10 = 0 AS evaluates, step % 20 = 0 AS saves
        FROM runs""",
    "metric_log_stream": f"""WITH {_TIMED}, logged AS (
          SELECT *, step % 10 = 0 AS evaluates FROM timed WHERE step % 5 = 0)
        SELECT sink, run_id, step, round(step / 20.0, 6) AS epoch, CASE WHEN NOT evaluates THEN loss END AS train_loss,
               CASE WHEN NOT evaluates THEN round(0.0005::DOUBLE * CASE WHEN step < 10 THEN step / 10.0::DOUBLE
                   ELSE greatest(0.0, 0.5 * (1 + cos(pi() * ((step - 10) / 90::DOUBLE)))) END, 10) END AS learning_rate,
               CASE WHEN evaluates THEN loss END AS eval_loss,
               CASE WHEN evaluates AND loss <> 0 THEN format('{{:.6e}}', exp(loss))::DOUBLE END AS eval_perplexity,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp
        FROM logged CROSS JOIN (SELECT unnest(['table', 'csv']) AS sink)""",
    "resumed_log_stream": f"""WITH {_TIMED}, broken AS (
          SELECT *, max(step) OVER (PARTITION BY run_id) * 2 // 3 AS last_step FROM timed)
        SELECT run_id, step, CASE WHEN step <= last_step THEN loss ELSE loss * 1.5 END AS loss FROM broken""",
    "prepared_stream": f"""WITH {_IDS}, versions AS (
          SELECT doc_id, pos, CASE WHEN doc_id % 4 >= 2 AND id >= 1000 THEN 1 ELSE id END AS id,
                 CASE WHEN doc_id % 4 >= 2 THEN 2 ELSE 1 END AS vocabulary_version
          FROM ids WHERE pos < 512)
        SELECT doc_id, count(*)::INT AS n_tokens, md5(string_agg(id::VARCHAR, ' ' ORDER BY pos)) AS ids_md5,
               vocabulary_version::BIGINT AS vocabulary_version
        FROM versions GROUP BY doc_id, vocabulary_version""",
    "run_log_source": f"""WITH {_TIMED}, logged AS (
          SELECT *, step % 10 = 0 AS evaluates FROM timed WHERE step % 5 = 0)
        SELECT run_id, step, round(step / 20.0, 6) AS epoch, CASE WHEN NOT evaluates THEN loss END AS train_loss,
               CASE WHEN NOT evaluates THEN round(0.0005::DOUBLE * CASE WHEN step < 10 THEN step / 10.0::DOUBLE
                   ELSE greatest(0.0, 0.5 * (1 + cos(pi() * ((step - 10) / 90::DOUBLE)))) END, 10) END AS learning_rate,
               CASE WHEN evaluates THEN loss END AS eval_loss,
               CASE WHEN evaluates AND loss <> 0 THEN format('{{:.6e}}', exp(loss))::DOUBLE END AS eval_perplexity,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp
        FROM logged""",
    "written_subset": """SELECT count(*) AS subset_rows, sum(strlen(text))::BIGINT AS text_bytes, max(doc_id) AS last_id,
               true AS on_disk
        FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100)""",
    "named_corpus": f"""WITH {_DOCS}
        SELECT split, doc_id, md5(text || CASE split WHEN 'validation' THEN ' (second edition)' ELSE '' END) AS text_md5
        FROM docs WHERE split IN ('validation', 'test')""",
    "incremental_counts": f"WITH {_TOKS} SELECT doc_id, len(tokens)::BIGINT AS n_tokens FROM toks",
    "scored_window_perplexity": f"""WITH {_IDS} {_WINDOWS}, small AS (
          SELECT doc_id, split, pos, CASE WHEN id < 1000 THEN id ELSE 1 END AS id FROM ids),
        neighbours AS (
          SELECT split, id AS a, lead(id) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM small WHERE split = 'train'),
        model AS (SELECT a, b, count(*) AS n FROM neighbours WHERE b IS NOT NULL GROUP BY a, b),
        contexts AS (SELECT a, sum(n) AS n FROM model GROUP BY a),
        sequence AS (
          SELECT split, id AS b, lag(id) OVER (PARTITION BY split ORDER BY doc_id, pos) AS a,
                 row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS spot
          FROM small WHERE split <> 'train'),
        losses AS (
          SELECT q.split, k.b, k.e - k.p AS trg_len,
                 -ln((coalesce(m.n, 0) + 1.0::DOUBLE) / (coalesce(c.n, 0) + 1000)) AS nll
          FROM sequence q
          JOIN kept k ON q.split = k.split AND q.spot >= k.p AND q.spot < k.e
          LEFT JOIN model m ON q.a = m.a AND q.b = m.b
          LEFT JOIN contexts c ON q.a = c.a
          WHERE q.a IS NOT NULL),
        means AS (SELECT split, b, trg_len, avg(nll) AS mean FROM losses GROUP BY split, b, trg_len)
        SELECT split, sum(trg_len)::BIGINT AS n_tokens, round(exp(sum(mean * trg_len) / sum(trg_len)), 4) AS perplexity
        FROM means GROUP BY split""",
}
ORACLES["early_stop_stream"] = ORACLES["early_stop"]
