"""DuckDB texts that give the same rows as the queries of the same name."""

from samples.network import BIAS, WEIGHTS
from samples.views import with_views

_INDEX = "(select label, row_number() over (order by label) - 1 as idx from (select distinct label from files))"
_FILES = """, files as (select o_orderkey, filename, list_extract(string_split(filename, '/'), -2) as label from tile_files)"""


def _files(body: str) -> str:
    return with_views("tile_files", f"{_FILES} {body}")


def _hash(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0::double)"


def _one_vs_rest(source: str, more: str = "") -> str:
    return f"""
    select label, n_true_pos, n_true_neg, n_false_pos, n_false_neg,
           round(n_true_pos / nullif(n_true_pos + n_false_pos, 0), 9) as precision,
           round(n_true_pos / nullif(n_true_pos + n_false_neg, 0), 9) as recall,
           round((n_true_pos + n_true_neg) / (n_true_pos + n_true_neg + n_false_pos + n_false_neg), 9) as accuracy {more}
    from (select l.label,
                 count(*) filter (p.label = l.label and p.pred_label = l.label) as n_true_pos,
                 count(*) filter (p.label <> l.label and p.pred_label <> l.label) as n_true_neg,
                 count(*) filter (p.label <> l.label and p.pred_label = l.label) as n_false_pos,
                 count(*) filter (p.label = l.label and p.pred_label <> l.label) as n_false_neg
          from (select distinct label from {source}) l cross join {source} p group by l.label)"""


def _confusion(source: str) -> str:
    return f"""
    select a.label, b.label as pred_label, count(p.label) as n
    from (select distinct label from {source}) a cross join (select distinct label from {source}) b
    left join {source} p on p.label = a.label and p.pred_label = b.label group by a.label, b.label"""


_GRID = """, grid as (
    select *, dense_rank() over (order by llcrnrlon) - 1 as x_idx, dense_rank() over (order by llcrnrlat) - 1 as y_idx
    from located), size as (select max(x_idx) as max_x, max(y_idx) as max_y from grid)"""
_PALETTE = """, palette as (select * from (values ('Barren', 0, 255, 0), ('Cultivated', 255, 255, 255),
    ('Developed', 255, 0, 0), ('Forest', 0, 255, 0), ('Herbaceous', 0, 255, 0), ('Shrub', 0, 255, 0)) t(label, r, g, b))"""
_PIXELS = _GRID + _PALETTE + """, pixels as (
    select row_idx, col_idx, name, pred_label, r, g, b from (
      select max_y - y_idx as row_idx, x_idx as col_idx, name, pred_label,
             row_number() over (partition by x_idx, y_idx order by name desc, pred_label desc) as place
      from grid cross join size) join palette on label = pred_label where place = 1)"""
_LOCATED = "scored tile_index located"


def _lines(block: int) -> str:
    return f"""
    select y as row_idx, x // {block} as block_idx,
           string_agg(printf('%02X%02X%02X', coalesce(r, 0), coalesce(g, 0), coalesce(b, 0)), '' order by x) as line
    from size, unnest(range(max_y + 1)) ys(y), unnest(range(max_x + 1)) xs(x)
    left join pixels on row_idx = y and col_idx = x group by y, x // {block}"""


def _runs(side: int) -> str:
    """Pixels of one colour in a row within a line of a block, as text from left to right."""
    bits = f"((((row_idx // {side}) >> i) & 1) << (2 * i + 1)) | ((((col_idx // {side}) >> i) & 1) << (2 * i))"
    return f""", placed as (
        select list_sum(list_transform(range(0, 31), lambda i: {bits}))::bigint as z, row_idx, col_idx,
               printf('%02X%02X%02X', r, g, b) as colour from pixels),
      ranked as (select *, col_idx - row_number() over (partition by z, row_idx, colour order by col_idx) as run from placed),
      runs as (select z, row_idx, colour, min(col_idx) as first, count(*) as n from ranked group by z, row_idx, colour, run)
    select z, row_idx, string_agg(first || ':' || n || ':' || colour, ' ' order by first) as runs
    from runs group by z, row_idx"""


_EPOCHS = """, matched as (
    select regexp_extract(value,
      '^Finished Epoch\\[(\\d+) of \\d+\\]: \\[Training\\] loss = ([0-9.]+) \\* [0-9]+, metric = ([0-9.]+)% \\* [0-9]+ ([0-9.]+)s \\( ?([0-9.]+) samples/s\\);',
      ['epoch', 'loss', 'error_pct', 'duration', 'rate']) as m from loglines),
  means as (select m.epoch::double as epoch, avg(m.loss::double) as loss, avg(m.error_pct::double) as error_pct,
      avg(m.duration::double) as duration, avg(m.rate::double) as rate from matched where m.epoch <> '' group by 1)"""
_ACCURACY = "regexp_extract(value, '^Overall accuracy on test set: ([0-9.]+)', 1)"
_SERIES = " union all ".join(
    f"select '{metric}' as metric, string_agg(printf('%.4f', {column}), ' ' order by epoch) as series from means"
    for metric, column in (
        ("training_loss", "loss"),
        ("training_error_pct", "error_pct"),
        ("epoch_duration", "duration"),
        ("samples_per_sec", "rate"),
    )
)

_CARD = """select output_model_name as model, output_model_name, model_source, pretrained_model_type,
    retraining_type, classifier_type from card_values"""

_TILE = "'tile_' || vec_id || '.png'"
_KEY = f"'class_' || label || '/' || {_TILE}"
_BGR = """array_to_string(
    list_transform(range(1, 65), lambda i: printf('%02X%02X%02X', b[i], g[i], r[i])), '')"""
_SCORES = ", ".join(
    f"({w[0]}) * blue + ({w[1]}) * green + ({w[2]}) * red + ({bias})"
    for w, bias in zip(WEIGHTS.T.astype(int).tolist(), BIAS.astype(int).tolist())
)
_NETWORK_LABELS = f""", means as (
    select vec_id, label, list_sum(r) / 64.0::double - 114 as red, list_sum(g) / 64.0::double - 114 as green,
           list_sum(b) / 64.0::double - 114 as blue from tile_pixels),
  scores_of as (select vec_id, label, [{_SCORES}] as s from means),
  classes as (select list(label order by label) as names from (select distinct pred_label as label from scored)),
  network_labels as (
    select {_TILE} as name, 'class_' || label as label, names[list_position(s, list_max(s))] as pred_label
    from scores_of cross join classes)"""


def _blocks() -> str:
    """Pixels less the mean, and how many of the 64 fall into each eighth of 0..255."""

    def text(values: str) -> str:
        return f"array_to_string(list_transform({values}, lambda v: (v)::bigint::varchar), ' ')"

    means = " || ' ' || ".join(text(f"list_transform({c}, lambda w: w - 114)") for c in "bgr")
    shares = " || ' ' || ".join(
        text(f"list_transform(range(8), lambda k: len(list_filter({c}, lambda w: w // 32 = k)))") for c in "bgr"
    )
    return f"select {_TILE} as name, 'class_' || label as label, {means} as means, {shares} as shares from tile_pixels"


def _draws() -> str:
    return ", ".join(
        f"round({_hash(f''''s|3|{name}|' || {_KEY}''')}, 6) as \"{name}\""
        for name in ("top", "left", "brightness", "contrast", "saturation")
    )


_PLANTED = """select 'tile_' || vec_id as filepath, 'class_' || place as label, 'class_' || place as pred_label
    from (select vec_id, list_position(embedding[1:4], list_max(embedding[1:4])) - 1 as place from embeddings)"""


def _run_metrics(accuracy: str) -> str:
    return f"""{accuracy} union all
    select 'run' as run_id, metric, null::double as value_double, series from ({_SERIES})"""


ORACLES = {
    "path_label_name": with_views(
        "paths",
        """select page_id, list_extract(string_split(path, '/'), -2) as label,
                  list_extract(string_split(path, '/'), -1) as name from paths""",
    ),
    "label_index": _files(f"select label, idx from {_INDEX}"),
    "map_file": _files(
        f"""select filename, idx, row_number() over (order by md5('7' || filename), filename) - 1 as position
            from files join {_INDEX} using (label)"""
    ),
    "class_and_size": _files("select count(distinct label) as num_classes, count(*) as epoch_size from files"),
    "hash_sample": _files(
        f"""select o_orderkey, filename from files
            where {_hash("label || '/' || list_extract(string_split(filename, '/'), -1)")} < 0.25"""
    ),
    "argmax_label": with_views(
        "scores",
        """, classes as (select label, row_number() over (order by label) - 1 as idx
                         from (select distinct 'class_' || lpad((generate_subscripts(scores, 1) - 1)::varchar, 2, '0') as label
                               from scores))
           select vec_id, s.idx, c.label as pred_label
           from (select vec_id, (list_position(scores, list_max(scores)) - 1)::bigint as idx from scores) s
           join classes c on c.idx = s.idx""",
    ),
    "overall_accuracy": with_views(
        "pred",
        """select count(*) as n_total, count(*) filter (label = pred_label) as n_correct,
                  round(count(*) filter (label = pred_label) / count(*), 9) as accuracy from pred""",
    ),
    "one_vs_rest": with_views("pred", _one_vs_rest("pred")),
    "class_report": with_views(
        "pred",
        f"""select label,
              coalesce(printf('%.3f', recall), 'Undefined (class absent from the test set)') as recall,
              coalesce(printf('%.3f', precision), 'Undefined (class never predicted)') as precision,
              printf('%.3f', accuracy) as accuracy from ({_one_vs_rest("pred")})""",
    ),
    "confusion_long": with_views("pred", _confusion("pred")),
    "confusion_wide": with_views(
        "pred",
        "select label, "
        + ", ".join(f"count(*) filter (pred_label = '{i}') as pred_{i}" for i in range(10))
        + " from pred group by label",
    ),
    "metrics_at_scale": with_views(
        "pred_big",
        _one_vs_rest(
            "pred_big",
            """, (select count(*) from pred_big where pred_label not in (select label from pred_big)) as n_outside""",
        ),
    ),
    "confusion_at_scale": with_views("pred_big", _confusion("pred_big")),
    "located_predictions": with_views(_LOCATED, "select * from located"),
    "unmatched_tiles": with_views(
        "scored tile_index",
        """, p as (select filepath as name, count(*) as n_pred from scored group by 1),
             t as (select list_extract(string_split(filename, '/'), -1) as name, count(*) as n_tile from tile_index group by 1)
           select coalesce(sum(n_pred) filter (n_tile is null), 0)::bigint as n_unmatched_predictions,
                  coalesce(sum(n_tile) filter (n_pred is null), 0)::bigint as n_unmatched_tiles,
                  count(*) filter (n_pred > 1) as n_repeated_predictions,
                  count(*) filter (n_tile > 1) as n_repeated_tiles,
                  coalesce(sum(n_pred * n_tile), 0)::bigint as n_located
           from p full join t using (name)""",
    ),
    "head_tiles": with_views(
        _LOCATED,
        """select * from located
           order by name, pred_label, llcrnrlat, llcrnrlon, urcrnrlat, urcrnrlon limit 5""",
    ),
    "grid_index": with_views(
        _LOCATED, _GRID + "select name, pred_label, x_idx, y_idx, max_y as max_y_idx from grid cross join size"
    ),
    "pixel_table": with_views(_LOCATED, _PIXELS + "select * from pixels"),
    "raster_lines": with_views(_LOCATED, _PIXELS + _lines(64)),
    "epoch_means": with_views(
        "loglines",
        _EPOCHS
        + """select epoch, round(loss, 9) as loss, round(error_pct, 9) as error_pct,
                    round(duration, 9) as duration, round(rate, 9) as rate from means""",
    ),
    "epoch_series": with_views("loglines", _EPOCHS + _SERIES),
    "log_accuracy": with_views(
        "loglines", f"select {_ACCURACY}::double as accuracy from loglines where {_ACCURACY} <> ''"
    ),
    "run_metrics": with_views(
        "loglines pred_big",
        _EPOCHS
        + _run_metrics(
            """select 'run' as run_id, 'accuracy_on_test_set' as metric,
                      round(count(*) filter (label = pred_label) / count(*), 9) as value_double,
                      null::varchar as series from pred_big"""
        ),
    ),
    "job_log_report": with_views(
        "loglines",
        _EPOCHS
        + _run_metrics(
            f"""select 'run' as run_id, 'test_set_accuracy' as metric, round({_ACCURACY}::double, 9) as value_double,
                       null::varchar as series from loglines where {_ACCURACY} <> ''"""
        ),
    ),
    "model_card_row": with_views("card_values", _CARD),
    "card_roundtrip": with_views("card_values", _CARD),
    "predictions_roundtrip": with_views("scored", "select filepath as name, pred_label from scored"),
    "test_predictions_roundtrip": with_views(
        "pred_big",
        "select 'test/' || l_orderkey || '/' || l_linenumber as filepath, label, pred_label from pred_big",
    ),
    "tile_index_roundtrip": with_views(
        "tile_index",
        """select list_extract(string_split(filename, '/'), -1) as name, llcrnrlat, llcrnrlon, urcrnrlat, urcrnrlon
           from tile_index""",
    ),
    "label_index_roundtrip": _files(f"select label, idx from {_INDEX}"),
    "map_roundtrip": _files(f"select filename, idx from files join {_INDEX} using (label)"),
    "image_stats": with_views(
        "tile_pixels",
        f"""select {_TILE} as name, 'class_' || label as label, 8 as height, 8 as width,
                   list_sum(r)::bigint as red, list_sum(g)::bigint as green, list_sum(b)::bigint as blue from tile_pixels""",
    ),
    "flat_images": with_views(
        "tile_pixels", f"select {_TILE} as name, 8 as height, 3 as channels, {_BGR} as bgr from tile_pixels"
    ),
    "flat_images_by_folder": with_views(
        "tile_pixels", f"select {_TILE} as name, 8 as height, 3 as channels, {_BGR} as bgr from tile_pixels"
    ),
    "packed_flat_tiles": with_views("tile_pixels", f"select {_TILE} as name, {_BGR} as bgr from tile_pixels"),
    "packed_tiles": with_views(
        "tile_pixels", f"select {_TILE} as name, 'class_' || label as label, {_BGR} as bgr from tile_pixels"
    ),
    "sampled_tiles": with_views(
        "tile_pixels",
        f"""select {_TILE} as name, 'class_' || label as label, 8 as width from tile_pixels where {_hash(_KEY)} < 0.3""",
    ),
    "list_class_files": "select 'class_' || label as label, count(*) as n_files from embeddings group by label",
    "featurize_blocks": with_views("tile_pixels", _blocks()),
    "augmented_sizes": with_views(
        "tile_pixels",
        f"""select {_TILE} as name, 'class_' || label as label, 16 as height, 768 as n_bytes, {_draws()} from tile_pixels""",
    ),
    "augmented_features": with_views(
        "tile_pixels", f"select {_TILE} as name, 'class_' || label as label, 216 as n_features from tile_pixels"
    ),
    "onnx_featurize": with_views(
        "tile_pixels",
        f"""select {_TILE} as name, list_sum(b) / 64.0::double - 114 as b, list_sum(g) / 64.0::double - 114 as g,
                   list_sum(r) / 64.0::double - 114 as r from tile_pixels""",
    ),
    "network_labels": with_views(
        "tile_pixels scored", _NETWORK_LABELS + "select name, label, pred_label from network_labels"
    ),
    "job_score_network": with_views(
        "tile_pixels scored", _NETWORK_LABELS + "select name, pred_label from network_labels"
    ),
    # scaling keeps the mean of a channel; along each side the first block is 7/8 of the first pixel and 1/8 of the next
    "featurize_full_size": with_views(
        "tile_pixels",
        f"""select {_TILE} as name, 'class_' || label as label,
                   (list_sum(r) + list_sum(g) + list_sum(b) - 192 * 114)::bigint as total, (49 * b[1] + 7 * (b[2] + b[9]) + b[10] - 64 * 114)::bigint as corner
            from tile_pixels""",
    ),
    **{name: _PLANTED for name in ("train_lr", "train_rf", "train_last_layer", "train_mlp", "score_saved_model")},
    **{
        name: f"""select n_total, n_total as n_correct, 1.0::double as accuracy
                  from (select count(*) as n_total from embeddings where {_hash(_TILE)} >= 0.7)"""
        for name in ("job_train", "job_retrain", "job_retrain_dense", "job_retrain_steps")
    },
    "job_score": f"select {_TILE} as name, 'class_' || label as pred_label from embeddings",
    "linear_head": """
        with numbers as (select vec_id, label, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as v
                         from embeddings),
        head as (select label, pos, avg(v) as w from numbers group by label, pos),
        found as (select vec_id, h.label, sum(v * w) as score from numbers n join head h using (pos)
                  group by vec_id, h.label)
        select vec_id, (arg_max(label, score))::varchar as pred_label, round(max(score), 6) as score
        from found group by vec_id""",
    "linear_head_blocks": """
        with numbers as (select vec_id, label, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as v
                         from embeddings),
        head as (select label, pos, avg(v) as w from numbers group by label, pos)
        select vec_id, dense_rank() over (order by h.label::varchar) - 1 as place, round(sum(v * w), 6) as score
        from numbers n join head h using (pos) group by vec_id, h.label""",
    "raster_runs": with_views(_LOCATED, _PIXELS + _runs(16)),
    "raster_size": with_views(_LOCATED, _GRID + "select max_y + 1 as height, max_x + 1 as width from size"),
    "job_analyze": with_views(_LOCATED, _PIXELS + _runs(256)),
    "job_analyze_located": with_views(_LOCATED, "select * from located"),
    "job_analyze_classes": with_views(
        "pred_big",
        _one_vs_rest(
            "pred_big",
            """, 'given' as output_model_name, 'net' as model_source, 'alexnet' as pretrained_model_type,
               'last_only' as retraining_type, 'none' as classifier_type""",
        ),
    ),
    "confusion_cells": with_views("pred_big", f"select * from ({_confusion('pred_big')}) where n > 0"),
    "confusion_blocks": with_views(
        "pred",
        f"""select label, place // 3 as block, string_agg((place % 3) || ':' || n, ' ' order by place) as cells
            from ({_confusion("pred")}) join (select label as pred_label, row_number() over (order by label) - 1 as place
                                              from (select distinct label from pred)) using (pred_label)
            where n > 0 group by label, place // 3""",
    ),
}
