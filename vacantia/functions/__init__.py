"""Column expressions: text cleaning, rule tables, salary, skills, similarity."""
