"""The job's marts wired together from sources, functions and operators."""
