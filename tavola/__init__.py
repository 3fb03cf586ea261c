"""Tavola: menu and retail analytics as lazy PySpark DataFrame operators."""
