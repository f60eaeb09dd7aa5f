"""Order change audit: the state of a document at each of its versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions import codes as C, dates as D
from ledgerloom.functions.params import Params
from ledgerloom.operators.relational import pack_texts
from ledgerloom.operators.temporal import as_of, changes_at, version_as_of
from ledgerloom.operators.windows import fill_previous
from ledgerloom.session import cut, step
from ledgerloom.sources.catalog import Source

#: Columns of an archived order line.
LINE = ("po_header_id", "po_line_id", "line_num", "item_revision", "item_description", "vendor_product_num", "line_type_id", "category_id",
        "shipping_uom_quantity", "uom_code", "base_qty", "base_uom", "unit_price", "cancel_flag", "entity_change_type_code", "from_co_seq", "to_co_seq")
#: The piece of rows without a line number, last in the order.
NO_LINE = 2**62
FILLED = ("category_id", "categorycode", "entity", "cost_centre", "cost_centre_group", "activity", "future", "natural_account")


def change_word(c: Column) -> Column:
    return C.map_values(c, {"I": "New", ("U", "C"): "Changed"})


def header_status(cancelled: Column, low: Column, version: Column, change: Column) -> Column:
    return F.when(cancelled == "Y", F.lit("Cancelled")).when(low == version, change_word(change))


def line_status(cancelled: Column, low: Column, version: Column, change: Column) -> Column:
    here = F.when(cancelled == "Y", F.lit("CANCELLED")).otherwise(change_word(change))
    return F.when(low == version, here).otherwise("Changed")


def amendment(header: Column, line: Column) -> Column:
    """What a version did to the document."""
    return (F.when(line.isNull() & (header.isNull() | (header == "Changed")), F.lit("Header Amended"))
            .when((line == "New") & (header == "New"), F.lit("Original Document"))
            .when((line == "New") & (header.isNull() | (header == "Changed")), F.lit("Line Created"))
            .when(line != "New", F.lit("Line Amended")))


def _versions(src: Source) -> DataFrame:
    return src.scan("po_versions", "po_header_id version_id co_sequence")


def _names(src: Source, p: Params) -> DataFrame:
    return as_of(src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL"), p.today()).select("person_id", "display_name")


#: Header columns that a report shows as text.
DAYS = ("po_date_display", "po_changeorder_date", "version_date")


def header_versions(src: Source, p: Params) -> DataFrame:
    return _header_days(src, p).withColumns({c: D.dmy(F.col(c)) for c in DAYS})


def _header_days(src: Source, p: Params) -> DataFrame:
    versions = src.scan("po_versions", "po_header_id version_id co_sequence co_num change_order_desc originator_id originator_role "
                        "document_date creation_date")
    first = (src.scan("po_versions", "po_header_id document_date:first_date co_sequence").filter(F.col("co_sequence") == 0).drop("co_sequence"))
    suppliers = (src.scan("poz_suppliers", "vendor_id party_id segment1:supplier_num")
                 .join(src.scan("hz_parties", "party_id party_name:supplier_name"), "party_id").drop("party_id"))
    units = src.scan("hr_organization_units_f_tl", "organization_id:prc_bu_id name:businessunit")
    archive = p.narrow(src.table("po_headers_archive_all"), po_num="segment1")
    df = (version_as_of(archive, versions, ["po_header_id"]).join(first, "po_header_id")
          .join(units, "prc_bu_id").join(suppliers, "vendor_id"))
    return df.select(
        "po_header_id", "version_id", F.col("segment1").alias("po_number"), "type_lookup_code",
        F.col("co_sequence").alias("header_co_sequence"), F.trim("comments").alias("po_description"),
        F.coalesce("co_num", F.lit(0)).alias("co_num"), "change_order_desc", "originator_id", "originator_role", "entity_change_type_code",
        F.col("first_date").alias("po_date_display"), F.col("document_date").alias("po_changeorder_date"), F.col("creation_date").alias("version_date"),
        header_status(F.col("cancel_flag"), F.col("from_co_seq"), F.col("co_sequence"), F.col("entity_change_type_code")).alias("headerstatus"),
        "businessunit", "supplier_num", "supplier_name")


def versions_of(src: Source, heads: DataFrame | None = None) -> DataFrame:
    """The versions that ``heads`` has (po_header_id, version_id); without it all that have a header in force."""
    versions = _versions(src)
    if heads is None:
        heads = version_as_of(src.scan("po_headers_archive_all", "po_header_id from_co_seq to_co_seq"), versions, ["po_header_id"])
    return versions.join(heads.select("po_header_id", "version_id"), ["po_header_id", "version_id"], "left_semi")


def line_versions(src: Source, p: Params, heads: DataFrame | None = None) -> DataFrame:
    """Order lines changed in each version (``versions_of``), with the shipment and distribution in force.

    Built in steps, so that the shuffle files of one of them are on disk at a time.
    """
    versions = step(src.spark, lambda: versions_of(src, heads))
    ships = src.table("po_line_locations_archive_all")
    dists = src.table("po_distributions_archive_all")
    key = ["po_header_id", "po_line_id", "version_id"]
    codes = src.scan("gl_code_combinations", "code_combination_id segment1:entity segment2:cost_centre segment3:natural_account "
                     "segment4:activity segment5:future")

    def changed_lines() -> DataFrame:
        lines = step(src.spark, lambda: changes_at(src.table("po_lines_archive_all").select(*LINE), versions, ["po_header_id"],
                                                   [ships, dists], "po_line_id").drop("to_co_seq"))
        ship_now = step(src.spark, lambda: changes_at(ships, versions, ["po_header_id"], [dists], "line_location_id").select(
            *key, "line_location_id", F.col("assessable_value").alias("po_ordered_amount")))
        return lines.join(ship_now, key)

    changed = step(src.spark, changed_lines)
    # distributions are looked up for the lines and versions that are left only, and meet their accounts while they are narrow
    place = ["po_header_id", "po_line_id", "line_location_id"]
    dist_now = step(src.spark, lambda: version_as_of(
        dists.select(*place, "from_co_seq", "to_co_seq", "code_combination_id", F.col("deliver_to_person_id").alias("person_id")),
        changed.select(*place, "version_id", "co_sequence").distinct(), place).join(_names(src, p), "person_id").join(codes, "code_combination_id")
        .select(*key, "line_location_id", "code_combination_id", F.col("display_name").alias("requester"),
                "entity", "cost_centre", "natural_account", "activity", "future"))
    df = (changed.join(src.scan("po_line_types_vl", "line_type_id line_type"), "line_type_id")
          .join(src.scan("egp_categories_b", "category_id category_code:categorycode"), "category_id")
          .join(dist_now, [*key, "line_location_id"]))
    here = F.col("from_co_seq") == F.col("co_sequence")
    return df.select(
        F.col("po_header_id").alias("l_header"), F.col("version_id").alias("l_version"), "line_num", "item_revision", "item_description",
        "requester", "vendor_product_num", "line_type", F.col("shipping_uom_quantity").alias("quantity"),
        F.col("uom_code").alias("pricing_uom_code"), "base_qty", "base_uom", "unit_price", "po_ordered_amount", "cancel_flag",
        F.when(here, F.col("entity_change_type_code")).otherwise("C").alias("entity_line_change_type_code"),
        line_status(F.col("cancel_flag"), F.col("from_co_seq"), F.col("co_sequence"), F.col("entity_change_type_code")).alias("line_status"),
        "code_combination_id", "entity", "cost_centre", C.cost_centre_group(F.col("cost_centre")).alias("cost_centre_group"),
        "natural_account", "activity", "future", "category_id", "categorycode")


def _coding(src: Source, heads: DataFrame, lines: DataFrame, lines_per_chunk: int) -> DataFrame:
    """Of each document version and changed line the coding shown; a row without line status shows the values carried forward."""
    in_version = (F.col("po_header_id") == F.col("l_header")) & (F.col("version_id") == F.col("l_version"))
    coded = cut(heads.select("po_header_id", "version_id", "co_num")
                .join(lines.select("l_header", "l_version", "line_num", "line_status", "code_combination_id", *FILLED), in_version, "left")
                .drop("l_header", "l_version"))
    # an order of very many versions or lines is cut by version and line range, any other stays whole
    large = cut(coded.groupBy("po_header_id").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > lines_per_chunk)
                .select(F.col("po_header_id").alias("_large")))
    piece = F.when(F.col("_large").isNotNull(), F.struct("co_num", F.coalesce(F.floor(F.col("line_num") / lines_per_chunk), F.lit(NO_LINE))))
    sized = coded.join(large, F.col("po_header_id") == F.col("_large"), "left")
    filled = fill_previous(sized, {f"_fill_{c}": c for c in FILLED}, ["po_header_id"], ["co_num", "line_num", "code_combination_id"], 7, piece)
    shown = filled.withColumns({f"_show_{c}": F.when(F.col("line_status").isNull(), F.col(f"_fill_{c}")).otherwise(F.col(c)) for c in FILLED})
    return shown.select("po_header_id", "version_id", "co_num", F.col("line_num").alias("_line"), F.col("line_status").alias("_status"),
                        *(F.col(f"_show_{c}").alias(f"_cc_{c}") for c in FILLED))


def _piece(lines_per_chunk: int) -> Column:
    return F.coalesce(F.floor(F.col("line_num") / lines_per_chunk).cast("bigint"), F.lit(NO_LINE))


def _audit_parts(src: Source, p: Params, lines_per_chunk: int) -> tuple[DataFrame, DataFrame]:
    """The shown headers (``_head``) and the changed lines of each, both with their place in the report's order and the coding shown.

    The lines of a header are cut into pieces (``_piece``) by line number; a header comes once a piece, one without lines once.
    """
    names = _names(src, p).groupBy(F.col("person_id").alias("originator_id")).agg(F.collect_set(F.struct("display_name")).alias("_names"))
    heads = cut(_header_days(src, p).join(names, "originator_id", "left"))
    lines = step(src.spark, lambda: line_versions(src, p, heads).withColumn("_piece", _piece(lines_per_chunk)))
    coding = step(src.spark, lambda: _coding(src, heads, lines, lines_per_chunk))
    key = ["po_header_id", "version_id", "co_num"]
    by_line = coding.filter(F.col("_status").isNotNull()).drop("_status").withColumnRenamed("_line", "line_num").withColumn(
        "_piece", _piece(lines_per_chunk))
    by_head = (coding.filter(F.col("_status").isNull()).drop("_status", "_line")
               .withColumnsRenamed({f"_cc_{c}": f"_c_{c}" for c in FILLED}))
    pieces = lines.select(F.col("l_header").alias("po_header_id"), F.col("l_version").alias("version_id"), "_piece").distinct()
    headed = (heads.join(pieces, ["po_header_id", "version_id"], "left").join(by_head, key, "left")
              .withColumn("_name", F.explode_outer(F.col("_names.display_name")))
              .withColumn("initiator_name", F.when(F.col("originator_role") == "SYSTEM", F.lit("System")).otherwise(F.col("_name"))).drop("_names", "_name"))
    # unit and supplier may differ between the versions of an order, so they narrow only what is shown, not what is carried
    headed = cut(p.narrow(headed, business_unit="businessunit", suppliernum="supplier_num", originatorrole="initiator_name")
                 .withColumn("_head", F.monotonically_increasing_id()))
    on = [F.col("po_header_id") == F.col("l_header"), F.col("version_id") == F.col("l_version"), F.col("_piece") == F.col("_l_piece")]
    changed, texts_of_line = pack_texts(lines.drop(*FILLED).withColumnRenamed("_piece", "_l_piece"), name="_of_line")
    by_line, texts_of_coding = pack_texts(by_line, name="_of_coding")
    placed = (headed.select("_head", *key, "po_number", "_piece").join(changed, on).join(by_line, [*key, "_piece", "line_num"], "left")
              .drop("po_header_id", "version_id", "l_header", "l_version", "_l_piece"))
    return headed, texts_of_coding(texts_of_line(placed))


def order_changes(src: Source, p: Params, lines_per_chunk: int = 10_000) -> DataFrame:
    """Each document version with its changed lines; coding is carried forward to header-only changes.

    Headers and lines meet in the ranges of the report's order, so that the wide rows of the report are never shuffled.
    """
    headed, placed = step(src.spark, lambda: _audit_parts(src, p, lines_per_chunk))
    (headed, texts_of_head), (placed, texts_of_line) = pack_texts(headed, ["po_number"], "_of_head"), pack_texts(placed, ["po_number"], "_of_line")
    place, key = [F.coalesce("_piece", F.lit(NO_LINE)).alias("_piece"), "po_number", "co_num", "_head"], {"_piece", "po_number", "co_num", "_head"}
    of_head, of_line = ([c for c in df.columns if c not in key] for df in (headed, placed))
    fed = headed.select(*place, F.struct(F.col("_piece").isNull().alias("_alone"), *of_head).alias("_h")).unionByName(
        placed.select(*place, F.struct(*of_line).alias("_l")), allowMissingColumns=True)
    order = [F.asc_nulls_last("po_number"), F.asc_nulls_last("co_num"), F.asc_nulls_last("_piece")]
    # the header is the first row of its piece
    own = Window.partitionBy("po_number", "co_num", "_piece", "_head").orderBy(F.col("_l").isNotNull())
    first = F.first("_h").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = (fed.repartitionByRange(*order).withColumn("_h", first).filter(F.col("_l").isNotNull() | F.col("_h._alone"))
          .withColumns({**{c: F.col(f"_h.{c}") for c in of_head}, **{c: F.col(f"_l.{c}") for c in of_line}}).drop("_h", "_l"))
    df = (texts_of_line(texts_of_head(df))
          .withColumns({c: F.coalesce(f"_cc_{c}", f"_c_{c}") for c in FILLED})
          .withColumn("status", amendment(F.col("headerstatus"), F.col("line_status"))))
    df = p.narrow(df, costcentre="cost_centre", costcentregroup="cost_centre_group", category_code="category_id")
    return df.orderBy(*order, F.asc_nulls_last("line_num")).withColumns({c: D.dmy(F.col(c)) for c in DAYS}).select(
        "po_header_id", "version_id", "po_number", "type_lookup_code", "header_co_sequence", "po_description", "co_num", "change_order_desc",
        "originator_id", "originator_role", "entity_change_type_code", "po_date_display", "po_changeorder_date", "version_date", "headerstatus",
        "businessunit", "supplier_num", "supplier_name", "initiator_name", "status", "line_num", "item_revision", "item_description", "requester",
        "vendor_product_num", "line_type", "quantity", "pricing_uom_code", "base_qty", "base_uom", "unit_price", "po_ordered_amount", "cancel_flag",
        "entity_line_change_type_code", "line_status", "code_combination_id", "entity", "cost_centre", "cost_centre_group", "natural_account",
        "activity", "future", "category_id", "categorycode")
