"""Table operators on Spark that turn question-and-answer dumps into training sets."""
