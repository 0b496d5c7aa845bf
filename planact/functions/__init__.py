from planact.functions import cleaning, compare, dates, display, materials, rounding

__all__ = ["cleaning", "compare", "dates", "display", "materials", "rounding"]
