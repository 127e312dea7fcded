"""Current inventory export (X2): the stock fact with 13 dimensions, 42 columns.

Join plan: three mandatory dimensions (inner, J4) and four optional ones
(left, J5) hang off the fact; the product's five attribute dimensions and
the model's brand are folded into a denormalised product / model dimension
first (J6), so the fact meets each key once. Spark picks each join from sizes in
bytes: small label tables are broadcast, while a product or model dimension above
the threshold is sort-merge joined on its key, where AQE can split a skewed key.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import nonzero_or_null, when_all_positive
from ..operators.joins import join_dimension
from ..schema import ColumnSpec, OutputSchema
from .job import BatchJob, Destination, RunContext

# The export's column names and their order.
COLUMNS = [
    "Entity", "Stock ID", "Product ID", "PO ID", "PO Item ID", "Warehouse", "Country",
    "Location", "Status", "Type", "Is Accessory", "Purchase Channel", "Stock Creation",
    "Product Creation", "Product Update", "Last Verification", "SKU", "Brand", "Model ID",
    "Model", "Dexterity", "Condition", "Condition Category", "Shaft Material", "Flex", "Loft",
    "Pieces", "Loft Degree", "Length", "Length Difference", "Is Available for Sale",
    "Is VAT Margin Schema Eligible", "Original Currency", "Total Quantity",
    "Available Quantity", "Sold Quantity", "Paid Quantity", "Cost", "Expected Resale Price",
    "Regular Resale Price", "Final Resale Price", "Expected Resale Margin",
]

SCHEMA = OutputSchema("current_inventory",
                      *[ColumnSpec(c, primary_key=(c == "Stock ID")) for c in COLUMNS])

DIMENSIONS = ["dim_warehouse", "dim_product_status", "dim_product_type", "dim_entity",
              "dim_product", "dim_model", "dim_brand", "dim_dexterity", "dim_standard_flex",
              "dim_standard_loft", "dim_shaft_material", "dim_product_condition",
              "dim_purchase_channel"]


@dataclass
class InventoryExportParameters:
    category: str = "Inventory"
    max_date: str | None = None


def _na(c):
    return F.coalesce(c, F.lit("N/A"))


def _yes_no(flag, yes="Yes", no="No"):
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def product_dimension(d: Mapping[str, DataFrame]) -> DataFrame:
    """Product with its attribute labels (one row per product)."""
    p = d["dim_product"]
    for dim, key, label in [("dim_dexterity", "dexterity_id", "dexterity"),
                            ("dim_standard_flex", "standard_flex_id", "flex"),
                            ("dim_standard_loft", "standard_loft_id", "loft"),
                            ("dim_shaft_material", "shaft_material_id", "shaft_material"),
                            ("dim_product_condition", "condition_id", "condition")]:
        lab = d[dim].select(F.col("id").alias(f"_{label}_id"), F.col("name").alias(f"{label}_name"))
        p = p.join(lab, p[key] == lab[f"_{label}_id"], "left").drop(f"_{label}_id")
    return p


def model_dimension(d: Mapping[str, DataFrame]) -> DataFrame:
    """Model with its brand label (one row per model)."""
    m = d["dim_model"].select("id", F.col("name").alias("model_name"), "brand_id")
    b = d["dim_brand"].select(F.col("id").alias("_brand_id"), F.col("name").alias("brand_name"))
    return m.join(b, m.brand_id == b._brand_id, "left").drop("_brand_id")


class InventoryExport(BatchJob):
    """Inputs: ``fact_inventory_current`` and the 13 dimensions."""

    parameter_class = InventoryExportParameters
    schema = SCHEMA
    destination = Destination(export_name="current_inventory", gzip_copy=True)

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.sources = sources

    def extract(self, spark: SparkSession, params, ctx: RunContext) -> dict[str, DataFrame]:
        return {"data": self.sources["fact_inventory_current"]}

    def transform(self, inputs, params, ctx: RunContext) -> DataFrame:
        d = self.sources
        f = inputs["data"]
        f = join_dimension(f, d["dim_warehouse"], "warehouse_id", "id", "inner", prefix="w_")
        f = join_dimension(f, d["dim_product_status"], "product_status_id", "id", "inner",
                           prefix="ps_")
        f = join_dimension(f, d["dim_product_type"], "product_type_id", "id", "inner", prefix="pt_")
        f = join_dimension(f, d["dim_entity"], "entity_id", "id", "left", prefix="e_")
        # the denormalised dims have exactly the rows of dim_product / dim_model
        f = join_dimension(f, product_dimension(d), "product_id", "id", "left", prefix="p_")
        f = join_dimension(f, model_dimension(d), "model_id", "id", "left", prefix="m_")
        f = join_dimension(f, d["dim_purchase_channel"], "channel_id", "id", "left", prefix="ch_")
        c = F.col
        cost_fx = F.round(c("fx_rate") * c("cost"), 2)
        cond = c("p_condition_id")
        exprs = {
            "Entity": c("e_code"),
            "Stock ID": c("stock_id"),
            "Product ID": c("product_id"),
            "PO ID": c("purchase_order_id"),
            "PO Item ID": c("purchase_order_item_id"),
            "Warehouse": c("w_code"),
            "Country": c("w_country_code"),
            "Location": c("location_name"),
            "Status": c("ps_name"),
            "Type": c("pt_name"),
            "Is Accessory": _yes_no(c("pt_is_golf_club"), "No", "Yes"),
            "Purchase Channel": c("ch_name"),
            "Stock Creation": c("stock_creation_date"),
            "Product Creation": c("product_creation_date"),
            "Product Update": c("product_change_date"),
            "Last Verification": c("last_verification_date"),
            "SKU": c("sku"),
            "Brand": _na(c("m_brand_name")),
            "Model ID": c("model_id"),
            "Model": _na(c("m_model_name")),
            "Dexterity": _na(c("p_dexterity_name")),
            "Condition": _na(c("p_condition_name")),
            "Condition Category": F.when(F.coalesce(cond, F.lit(0)) == 0, F.lit("N/A"))
                                   .when(cond == 1, F.lit("New")).otherwise(F.lit("Used")),
            "Shaft Material": _na(c("p_shaft_material_name")),
            "Flex": _na(c("p_flex_name")),
            "Loft": _na(c("p_loft_name")),
            "Pieces": F.coalesce(c("p_club_count"), F.lit(1)),
            "Loft Degree": c("p_loft_degree"),
            "Length": c("p_length"),
            "Length Difference": c("p_length_difference"),
            "Is Available for Sale": _yes_no(c("is_available_for_sale")),
            "Is VAT Margin Schema Eligible": _yes_no(c("is_vat_margin_scheme_eligible")),
            "Original Currency": c("currency"),
            "Total Quantity": c("total_qty"),
            "Available Quantity": c("available_qty"),
            "Sold Quantity": c("sold_qty"),
            "Paid Quantity": c("paid_qty"),
            "Cost": cost_fx,
            "Expected Resale Price": nonzero_or_null(
                "expected_resale_price", F.round(c("fx_rate") * c("expected_resale_price"), 2)),
            "Regular Resale Price": c("regular_resale_price"),
            "Final Resale Price": c("final_resale_price"),
            "Expected Resale Margin": when_all_positive(
                ["cost", "final_resale_price", "fx_rate"],
                F.round((c("final_resale_price") - F.round(c("cost") * c("fx_rate"), 2))
                        / c("final_resale_price"), 4)),
        }
        return f.select(*[e.alias(n) for n, e in exprs.items()])
