from starloom.functions.columns import day_number, model_category, padded, revenue_per_unit

__all__ = ["day_number", "model_category", "padded", "revenue_per_unit"]
