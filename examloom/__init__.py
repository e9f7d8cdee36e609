"""Exam-question data preparation and scoring on Spark DataFrames."""
