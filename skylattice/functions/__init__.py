"""Column functions and period bounds shared by the operators."""
