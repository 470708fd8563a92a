"""Rich-text tokens of normalized documents as rows, and the walks over them as plain aggregates.

The rows are the nodes of ``operators.nested``: a Dewey label gives document order at any depth, so counting, searching
and numbering need no recursion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import indent_class, ordered_type, paragraph_css, rgb, run_css, run_tags, span_attributes
from folioforge.operators import nested

# Slots that hold runs.
RUN_SLOTS = ["runs", "title_runs", "body_runs"]


def tokens(records: DataFrame) -> DataFrame:
    """record_id, node_path, parent_path, dewey, field, slot, t and the values of each run."""
    flat = nested.flatten(records).where(F.col("table").startswith("fields"))
    slot = F.regexp_extract("table", r"([^.]+)$", 1)
    value = lambda k: F.get_json_object("content", f"$.{k}")
    own = flat.where(slot.isin(RUN_SLOTS))
    return own.select("record_id", "node_path", "parent_path", "dewey", "depth", F.regexp_extract("node_path", r"^fields\.(.+?)\.(?:runs|title_runs|body_runs|rows)\[", 1).alias("field"), slot.alias("slot"), value("t").alias("t"), value("text").alias("text"), value("label").alias("label"), value("href").alias("href"), value("name").alias("name"), value("displayname").alias("displayname"), value("alt").alias("alt"), value("s").alias("s"), value("a").alias("a"), value("attributes").alias("attributes"))


def counts(toks: DataFrame) -> DataFrame:
    """Tokens of each kind per record."""
    return toks.groupBy("record_id", "t").agg(F.count("*").alias("n"))


def first(toks: DataFrame, kind: str) -> DataFrame:
    """The first token of a kind of each record in document order."""
    return toks.where(F.col("t") == kind).groupBy("record_id").agg(F.min(F.struct("dewey", "node_path", "text", "label", "name", "alt")).alias("m")).select("record_id", "m.node_path", "m.text", "m.label", "m.name", "m.alt")


def plain_text(toks: DataFrame) -> DataFrame:
    """The text of each field, pieces in document order. A field's pieces are those of one document."""
    piece = F.when(F.col("t") == "text", F.col("text")).when(F.col("t") == "link", F.col("label")).when(F.col("t").isin("par", "br"), "\n").when(F.col("t") == "attachmentref", F.concat(F.lit("["), "displayname", F.lit("]"))).when(F.col("t") == "img", F.concat(F.lit("[Image: "), "alt", F.lit("]"))).when(F.col("t") == "hr", "\n---\n")
    rows = toks.withColumn("piece", piece).where(F.col("piece").isNotNull())
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dewey", "node_path", "piece"))), lambda x: x["piece"]), "")
    return rows.groupBy("record_id", "field").agg(F.regexp_replace(joined, r"^\n+|\s+$", "").alias("text"))


def merged(toks: DataFrame) -> DataFrame:
    """Adjacent texts of equal style in one list as one: gaps and islands within the list."""
    w = W.partitionBy("record_id", "parent_path", "slot").orderBy("dewey")
    style = F.struct("t", F.coalesce("s", F.lit("")), F.coalesce("a", F.lit("")))
    change = ~((F.col("t") == "text") & F.coalesce(F.lag(style).over(w) == style, F.lit(False)))
    own = toks.withColumn("isle", F.sum(change.cast("int")).over(w))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dewey", "text"))), lambda x: x["text"]), "")
    return own.where("t = 'text'").groupBy("record_id", "parent_path", "slot", "isle", "s", "a").agg(F.min("node_path").alias("node_path"), F.count("*").alias("n"), text.alias("text")).drop("isle")


def paragraphs(toks: DataFrame) -> DataFrame:
    """Paragraph marks with their style and how they stand: repeated (same attributes, nothing between) or not."""
    w = W.partitionBy("record_id", "parent_path", "slot").orderBy("dewey")
    get = lambda k: F.get_json_object("a", f"$.{k}")
    again = (F.lag("t").over(w) == "par") & F.coalesce(F.lag("a").over(w), F.lit("")).eqNullSafe(F.coalesce("a", F.lit("")))
    own = toks.withColumn("again", F.coalesce(again, F.lit(False))).where("t = 'par'")
    return own.select("record_id", "node_path", "again", paragraph_css(get("align"), get("spaceafter")).alias("css"), indent_class(get("leftmargin")).alias("indent"), get("list.type").alias("list"), ordered_type(get("list.type")).alias("ol_type"))


def list_items(toks: DataFrame) -> DataFrame:
    """Runs of consecutive list paragraphs of one kind as one list, items numbered; the number starts again after a gap."""
    w = W.partitionBy("record_id", "parent_path", "slot").orderBy("dewey")
    pars = toks.where("t = 'par'").withColumn("kind", F.coalesce(F.get_json_object("a", "$.list.type"), F.lit("")))
    change = F.coalesce((F.lag("kind").over(w) != F.col("kind")).cast("int"), F.lit(1))
    grouped = pars.withColumn("change", change).withColumn("list_no", F.sum("change").over(w))
    place = W.partitionBy("record_id", "parent_path", "slot", "list_no").orderBy("dewey")
    return grouped.withColumn("item", F.row_number().over(place)).where("kind <> ''").select("record_id", "node_path", "kind", "list_no", "item")


def images(toks: DataFrame) -> DataFrame:
    """Inline images numbered through a record in document order, through tables and sections."""
    w = W.partitionBy("record_id").orderBy("dewey")
    return toks.where("t = 'img'").withColumn("seq", F.row_number().over(w) - 1).select("record_id", "node_path", "alt", "seq")


def indents(toks: DataFrame) -> DataFrame:
    """Each token with the last meaningful indent before it in its list."""
    w = W.partitionBy("record_id", "parent_path", "slot").orderBy("dewey").rowsBetween(W.unboundedPreceding, 0)
    own = toks.withColumn("indent", F.when(F.col("t") == "par", indent_class(F.get_json_object("a", "$.leftmargin"))))
    return own.withColumn("indent", F.coalesce(F.last(F.when(F.col("indent") != "", F.col("indent")), ignorenulls=True).over(w), F.lit(""))).where("t <> 'par'").select("record_id", "node_path", "t", "indent")


def run_styles(toks: DataFrame) -> DataFrame:
    """Tags, style and colour of each text or link."""
    get = lambda k: F.get_json_object("a", f"$.{k}")
    styles = F.coalesce(F.from_json("s", "array<string>"), F.array().cast("array<string>"))
    return toks.where(F.col("t").isin("text", "link")).select("record_id", "node_path", F.array_join(run_tags(styles, get("script")), " ").alias("tags"), run_css(get("color"), get("bgcolor"), get("size")).alias("css"), rgb(get("color")).alias("rgb"))


def links(toks: DataFrame) -> DataFrame:
    """Links of a record: to notes if they name one, to the web by their address; others are no links."""
    notes = F.get_json_object("a", "$.notes.unid")
    kind = F.when(notes.isNotNull(), "notes").when(F.lower("href").rlike("^https?://"), "http")
    return toks.where("t = 'link'").select("record_id", "node_path", kind.alias("kind"), "href", "label").where(F.col("kind").isNotNull())


def table_widths(records: DataFrame) -> DataFrame:
    """Rows and widest row (in columns spanned) of every table."""
    flat = nested.flatten(records)
    cells = flat.where(F.col("table").endswith(".cells"))
    span = F.coalesce(F.get_json_object("content", "$.colspan").try_cast("int"), F.lit(1))
    rows = cells.groupBy("record_id", F.col("parent_path").alias("row_path")).agg(F.sum(span).alias("width"))
    tables = rows.withColumn("table_path", F.regexp_replace("row_path", r"\.rows\[\d+\]$", ""))
    return tables.groupBy("record_id", "table_path").agg(F.count("*").alias("n_rows"), F.max("width").alias("n_columns"))


def cell_attributes(records: DataFrame) -> DataFrame:
    """HTML attributes of every table cell."""
    get = lambda k: F.get_json_object("content", f"$.{k}")
    cells = nested.flatten(records).where(F.col("table").endswith(".cells"))
    return cells.select("record_id", "node_path", span_attributes(F.coalesce(get("colspan"), get("columnspan")), get("rowspan"), F.coalesce(get("style.bgcolor"), get("style.style.bgcolor"))).alias("attributes"))


GRID = "record_id long, table_path string, row int, col int, node_path string"


def grid(records: DataFrame) -> DataFrame:
    """Where each cell of a table stands once row and column spans take their places: row and column of its top left corner.

    A table is one document's, so its cells are folded together; tables are spread over all tasks.
    """
    import pandas as pd

    cells = nested.flatten(records).where(F.col("table").endswith(".cells"))
    span = lambda k: F.greatest(F.coalesce(F.get_json_object("content", f"$.{k}").try_cast("int"), F.lit(1)), F.lit(1))
    own = cells.select("record_id", "node_path", F.regexp_replace("node_path", r"\.rows\[\d+\]\.cells\[\d+\]$", "").alias("table_path"), F.element_at("dewey", -2).alias("r"), F.element_at("dewey", -1).alias("c"), span("colspan").alias("cs"), span("rowspan").alias("rs"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: set[tuple[int, int]] = set()
        out = []
        at = {}
        for x in pdf.sort_values(["r", "c"]).itertuples():
            col = at.get(x.r, 0)
            while (x.r, col) in taken:
                col += 1
            taken.update((x.r + i, col + j) for i in range(x.rs) for j in range(x.cs))
            at[x.r] = col + x.cs
            out.append((x.record_id, x.table_path, x.r, col, x.node_path))
        return pd.DataFrame(out, columns=["record_id", "table_path", "row", "col", "node_path"])

    return own.groupBy("record_id", "table_path").applyInPandas(place, GRID)
