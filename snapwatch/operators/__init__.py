"""Operators: every public function takes and returns DataFrames and stays lazy."""
