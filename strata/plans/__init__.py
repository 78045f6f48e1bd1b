"""End-to-end jobs (extract, enrich, export, profile) built from the operators."""
