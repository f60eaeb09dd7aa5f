"""Finance, purchasing and people reports over ERP tables, written as Spark DataFrame plans."""
