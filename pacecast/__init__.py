"""Booking-pace forecasting analytics as lazy PySpark DataFrame operators."""
