"""Reusable Column expressions: text, dates, numbers and business rules."""

from salesmart.functions import business, dates, numbers, text  # noqa: F401
