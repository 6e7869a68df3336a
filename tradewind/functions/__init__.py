"""Column expressions shared by the plans; everything here stays inside the JVM."""
