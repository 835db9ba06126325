"""The product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: the seed catalogue
SEED_PRODUCTS = [
    ("PROD-001", "Samsung Galaxy S24", "Electronics", "55000.00"),
    ("PROD-002", "Apple AirPods Pro", "Electronics", "22000.00"),
    ("PROD-003", "Nike Air Max 270", "Footwear", "8500.00"),
    ("PROD-004", "Adidas Running T-Shirt", "Clothing", "1299.00"),
    ("PROD-005", "Prestige Pressure Cooker", "Kitchen", "2500.00"),
    ("PROD-006", "boAt Rockerz 450", "Electronics", "1999.00"),
    ("PROD-007", "Levi Jeans 511", "Clothing", "3499.00"),
    ("PROD-008", "Instant Pot Duo", "Kitchen", "7500.00"),
    ("PROD-009", "Puma Sports Shoes", "Footwear", "4500.00"),
    ("PROD-010", "Himalaya Face Wash", "Beauty", "299.00"),
    ("PROD-011", "Kindle Paperwhite", "Electronics", "14000.00"),
    ("PROD-012", "Wildcraft Backpack 45L", "Accessories", "3200.00"),
]


def seed_products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SEED_PRODUCTS, "product_id STRING, product_name STRING, category STRING, price STRING"
    ).selectExpr("product_id", "product_name", "category", "cast(price as decimal(10,2)) base_price")


def with_seed(catalogue: DataFrame) -> DataFrame:
    """``catalogue`` plus the seed products it does not hold yet."""
    seed = seed_products(catalogue.sparkSession)
    # look the few seed ids up in the catalogue; the catalogue itself is not moved
    known = catalogue.select("product_id").join(seed, "product_id", "left_semi")
    missing = seed.join(known, "product_id", "left_anti")
    return catalogue.select(*seed.columns).unionByName(missing)
