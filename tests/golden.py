"""Sample inputs of the reference's golden run (values that fix its numbers).

Fixed values: the four raw sources exactly as given (header row first).
"""

PROVIDERS = [
    ("provider_id", "provider_name", "provider_type", "region_id"),
    ("P001", "CHU Paris Nord", "hospital", "R11"),
    ("P002", "Cabinet Lyon Centre", "general_practitioner", "R84"),
    ("P003", "Clinique Marseille Sud", "clinic", "R93"),
    ("P004", "Pharmacie Lille Nord", "pharmacy", "R32"),
    ("P005", "Hopital Nantes Atlantique", "hospital", "R52"),
]
CLAIMS = [
    ("provider_id", "region_id", "treatment_category", "claim_month", "claim_count", "total_billed",
     "total_reimbursed", "claim_status"),
    ("P001", "R11", "cardiology", "2025-01", "20", "9200.00", "7600.00", "approved"),
    ("P001", "R11", "radiology", "2025-02", "12", "4100.00", "3250.00", "approved"),
    ("P002", "R84", "general_consultation", "2025-01", "35", "5250.00", "4500.00", "approved"),
    ("P003", "R93", "orthopedics", "2025-01", "18", "6800.00", "5700.00", "approved"),
    ("P004", "R32", "pharmacy", "2025-01", "25", "2100.00", "1750.00", "approved"),
    ("P005", "R52", "emergency", "2025-02", "16", "7900.00", "6000.00", "approved"),
]
PRESCRIPTIONS = [
    ("provider_id", "region_id", "treatment_category", "claim_month", "prescription_count", "total_quantity"),
    ("P001", "R11", "cardiology", "2025-01", "15", "130"),
    ("P002", "R84", "general_consultation", "2025-01", "42", "285"),
    ("P003", "R93", "orthopedics", "2025-01", "10", "74"),
    ("P004", "R32", "pharmacy", "2025-01", "58", "460"),
    ("P005", "R52", "emergency", "2025-02", "8", "49"),
]
REGIONS = [
    ("region_id", "region_name", "population_group"),
    ("R11", "Ile-de-France", "high"),
    ("R84", "Auvergne-Rhone-Alpes", "high"),
    ("R93", "Provence-Alpes-Cote dAzur", "medium"),
    ("R32", "Hauts-de-France", "medium"),
    ("R52", "Pays de la Loire", "medium"),
]
SOURCES = {"providers": PROVIDERS, "claims": CLAIMS, "prescriptions": PRESCRIPTIONS, "regions": REGIONS}
GOLDEN_SEED = 20260308


def frame(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in rows[0]])
    return spark.createDataFrame([tuple(r) for r in rows[1:]], schema)


def write_csv(path, rows, bom=True):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        for r in rows:
            f.write(",".join(r) + "\n")
