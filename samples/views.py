"""Whole given tables in the shape of the suite's inputs, as Spark and DuckDB texts.

Each view reads all rows of its table. Differences between rows (names that find no
partner, log spellings, classes) come from values, never from leaving rows out.
"""

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    # the numbers of a row as the scores of 64 classes
    "scores": "select vec_id, embedding scores from embeddings",
    "pred": """
        select vec_id, cast(label as string) label,
               cast((array_position(embedding, array_max(embedding)) - 1) % 10 as string) pred_label
        from embeddings""",
    "pred_big": """
        select l_orderkey, l_linenumber, l_returnflag label,
               case when (l_orderkey + l_linenumber) % 4 = 0 then l_linestatus
                    when l_orderkey % 7 = 0 then 'A' else l_returnflag end pred_label
        from lineitem""",
    "paths": "select page_id, split(url, '[?#]')[0] path from pages",
    "tile_files": """
        select o_orderkey, concat('train/', o_orderpriority, '/tile_', o_orderkey, '.png') filename from orders""",
    "tile_index": """
        select concat('tiles/', o_orderstatus, '/tile_', o_orderkey, '.png') filename,
               42.0d + floor(o_orderkey / 400) * 0.00390625d llcrnrlat,
               -71.0d + (floor(o_orderkey / 2) % 200) * 0.00390625d llcrnrlon,
               42.0d + (floor(o_orderkey / 400) + 1) * 0.00390625d urcrnrlat,
               -71.0d + (floor(o_orderkey / 2) % 200 + 1) * 0.00390625d urcrnrlon
        from orders""",
    "scored": """
        select concat('tile_', l_orderkey, if(l_linenumber = 1, '', concat('_', l_linenumber)), '.png') filepath,
               element_at(array('Barren', 'Cultivated', 'Developed', 'Forest', 'Herbaceous', 'Shrub'),
                          cast(l_suppkey % 6 + 1 as int)) pred_label
        from lineitem""",
    "loglines": """
        select event_id, case
          when event_type = 'signup' then concat('Overall accuracy on test set: 0.', lpad(event_id % 1000, 3, '0'))
          when event_type = 'error' then concat('noise ', event_id)
          else concat(if(event_id % 17 = 0, '  ', ''), 'Finished Epoch[', event_id % 40 + 1, ' of 40]: [Training] loss = ',
            event_id % 9, '.', event_id % 10, ' * 100, metric = ', event_id % 30, '.5% * 100 ', event_id % 13 + 1, '.25s ',
            if(event_id % 2 = 0, '( ', '('), event_id % 40, '.75 samples/s);') end value
        from events""",
    "card_values": """
        select concat('m', s_suppkey) output_model_name, if(s_nationkey % 2 = 0, 'classifier', 'dnn') model_source,
               if(s_suppkey % 2 = 0, 'resnet18', 'alexnet') pretrained_model_type,
               if(s_suppkey % 3 = 0, 'fully_connected', 'last_only') retraining_type,
               if(s_nationkey % 2 = 0, if(s_acctbal < 5000, 'randomforest', 'logisticregression'), 'none') classifier_type
        from supplier""",
    # tiles of 8 x 8 pixels whose three channels follow from the 64 numbers of a row
    "tile_pixels": """
        select vec_id, label, r, reverse(r) g, transform(r, v -> cast((v + vec_id) % 256 as int)) b
        from (select vec_id, label,
                     transform(embedding, e -> cast(greatest(0, least(255, floor(128 + 256 * cast(e as double)))) as int)) r
              from embeddings)""",
}

DUCKDB = {
    "scores": "select vec_id, embedding as scores from embeddings",
    "pred": """
        select vec_id, label::varchar as label,
               ((list_position(embedding, list_max(embedding)) - 1) % 10)::varchar as pred_label
        from embeddings""",
    "pred_big": """
        select l_orderkey, l_linenumber, l_returnflag as label,
               case when (l_orderkey + l_linenumber) % 4 = 0 then l_linestatus
                    when l_orderkey % 7 = 0 then 'A' else l_returnflag end as pred_label
        from lineitem""",
    "paths": "select page_id, regexp_replace(url, '[?#].*$', '') as path from pages",
    "tile_files": """
        select o_orderkey, 'train/' || o_orderpriority || '/tile_' || o_orderkey || '.png' as filename from orders""",
    "tile_index": """
        select 'tiles/' || o_orderstatus || '/tile_' || o_orderkey || '.png' as filename,
               42.0::double + (o_orderkey // 400) * 0.00390625::double as llcrnrlat,
               -71.0::double + ((o_orderkey // 2) % 200) * 0.00390625::double as llcrnrlon,
               42.0::double + (o_orderkey // 400 + 1) * 0.00390625::double as urcrnrlat,
               -71.0::double + ((o_orderkey // 2) % 200 + 1) * 0.00390625::double as urcrnrlon
        from orders""",
    "scored": """
        select 'tile_' || l_orderkey || (case when l_linenumber = 1 then '' else '_' || l_linenumber end) || '.png' as filepath,
               (['Barren', 'Cultivated', 'Developed', 'Forest', 'Herbaceous', 'Shrub'])[l_suppkey % 6 + 1] as pred_label
        from lineitem""",
    "loglines": """
        select event_id, case
          when event_type = 'signup' then 'Overall accuracy on test set: 0.' || lpad((event_id % 1000)::varchar, 3, '0')
          when event_type = 'error' then 'noise ' || event_id
          else (case when event_id % 17 = 0 then '  ' else '' end) || 'Finished Epoch[' || (event_id % 40 + 1)
            || ' of 40]: [Training] loss = ' || (event_id % 9) || '.' || (event_id % 10) || ' * 100, metric = '
            || (event_id % 30) || '.5% * 100 ' || (event_id % 13 + 1) || '.25s '
            || (case when event_id % 2 = 0 then '( ' else '(' end) || (event_id % 40) || '.75 samples/s);' end as value
        from events""",
    "card_values": """
        select 'm' || s_suppkey as output_model_name,
               case when s_nationkey % 2 = 0 then 'classifier' else 'dnn' end as model_source,
               case when s_suppkey % 2 = 0 then 'resnet18' else 'alexnet' end as pretrained_model_type,
               case when s_suppkey % 3 = 0 then 'fully_connected' else 'last_only' end as retraining_type,
               case when s_nationkey % 2 = 0 then (case when s_acctbal < 5000 then 'randomforest' else 'logisticregression' end)
                    else 'none' end as classifier_type
        from supplier""",
    "tile_pixels": """
        select vec_id, label, r, list_reverse(r) as g, list_transform(r, lambda v: ((v + vec_id) % 256)::int) as b
        from (select vec_id, label,
                     list_transform(embedding, lambda e: greatest(0, least(255, floor(128 + 256 * e::double)))::int) as r
              from embeddings)""",
    # inputs joined by name, as the suite names tiles
    "located": """
        select s.filepath as name, s.pred_label, t.llcrnrlat, t.llcrnrlon, t.urcrnrlat, t.urcrnrlon
        from scored s join tile_index t on s.filepath = list_extract(string_split(t.filename, '/'), -1)""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SPARK[name]
    table = text.split("from ")[-1].split(")")[0].strip()
    return spark.sql(
        text.replace(f"from {table}", "from {source}"),
        source=spark.read.parquet(f"{sf_dir}/{table}.parquet"),
    )


def with_views(names: str, body: str) -> str:
    """DuckDB query that starts with the named views."""
    views = ", ".join(f"{name} as ({DUCKDB[name]})" for name in names.split())
    return f"with {views} {body}"
