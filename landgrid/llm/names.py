"""Known given names by script and gender."""

from __future__ import annotations

# fixed values, from public name statistics; names that are ordinary words too (Will, Mark, Grace, May) are left out.
# Some are places or things as well (Victoria, Max): what stands around a name decides
GIVEN = {
    ("latin", "f"): """
Mary Anna Maria Emma Sophie Julia Laura Elena Lucia Camille Chloe Ingrid Sarah Linda Patricia Jennifer Elizabeth Susan Marie Claire
Emily Olivia Ava Sophia Isabella Charlotte Amelia Mia Evelyn Abigail Ella Avery Scarlett Luna Layla Penelope Riley Zoey Nora
Hannah Lillian Addison Eleanor Natalie Natalia Natasha Audrey Claudia Stella Victoria Caroline Alice Alicia Amanda
Amy Andrea Angela Angelica Ann Anne Annie Barbara Beatrice Bella Bernadette Bethany Betty Beverly Bianca Brenda Bridget Brittany
Carla Carmen Carol Carolina Catherine Cathy Cecilia Celine Charlene Cheryl Christina Christine Cindy Clara Claudine Colleen Connie
Courtney Cynthia Daniela Danielle Deborah Debra Delia Denise Diana Diane Dolores Donna Dora Doris Dorothy Edith Eileen Elaine
Elisa Elise Ellen Elsa Erica Erika Esther Eva Fatima Felicia Fernanda Fiona Frances Francesca Gabriela Gabrielle Geraldine Gertrude Giulia Gloria Greta Gwendolyn Heather Heidi Helen Helena Helga Henrietta Ida Ines Irene Isabel Isabelle Jacqueline
Jana Jane Janet Janice Jasmine Jean Jeanne Jessica Jill Joan Joanna Josephine Joyce Juanita Judith Judy Julie Juliet Karen Karin Katarina
Kate Katherine Kathleen Kathryn Katie Katrin Kayla Kelly Kimberly Kirsten Kristen Kristin Lara Lauren Leah Lena Leonie Leticia Lisa
Lois Louisa Louise Lucy Lydia Madeleine Magdalena Manuela Margaret Margarita Margot Marianne Marina Marion Marta Martha Martina
Matilda Megan Melanie Melissa Mercedes Michelle Mildred Miriam Molly Monica Monika Monique Nadia Nadine Nancy Naomi Nicole Nina Noemi
Olga Pamela Paula Pauline Petra Phyllis Priya Rachel Rebecca Regina Renate Rita Roberta Rosa Rosalie Rosemary Ruth Sabine Sabrina
Samantha Sandra Sara Sharon Sheila Shirley Silvia Simone Sofia Sonia Stefanie Stephanie Susanne Suzanne Svetlana Sylvia Tamara Tanya
Tatiana Teresa Theresa Tiffany Tina Tracy Ursula Valentina Valerie Vanessa Vera Veronica Vivian Wanda Wendy Yolanda Yvonne Zoe
Aisha Amina Ayesha Layan Leila Mariam Noor Zainab Mei Sakura Yuki Yuko Ananya Deepa Kavita Lakshmi Pooja Sunita Anjali
""".split(),
    ("latin", "m"): """
John James Robert Michael David William Thomas Daniel Paul Peter Pierre Louis Hans Klaus Carlos Juan Miguel Antonio Charles
Aaron Adam Adrian Alan Albert Alberto Alejandro Alex Alexander Alfred Alfredo Allen Andre Andreas Andrew Andy Angelo Anthony Arnold
Arthur Axel Barry Benjamin Bernard Bernd Bob Brandon Brian Bruce Bruno Bryan Calvin Carl Cesar Christoph Christopher Clarence
Claude Claudio Clifford Craig Curtis Dale Darren Dennis Derek Diego Dietmar Dieter Dirk Dominic Donald Douglas Duncan Dylan Edgar
Eduardo Edward Edwin Elias Emil Emilio Emmanuel Enrique Eric Erik Ernest Ernst Ethan Eugene Evan Felipe Felix Fernando Florian
Francesco Francis Francisco Francois Franz Fred Frederick Friedrich Fritz Gabriel Gareth Gary Geoffrey George Georg Gerald Gerhard
Giovanni Giuseppe Glenn Gordon Graham Greg Gregory Guido Guillaume Gustavo Harold Harry Harvey Hector Heinrich Heinz Helmut Henri Henry
Herbert Herman Howard Hugo Ian Ignacio Isaac Ivan Jacob Jacques Jakob Jamal Jan Jason Javier Jeff Jeffrey Jeremy Jerome Jesse Joachim Joaquin Joel Johann Johannes Johnny Jonathan Jorge Jose Joseph Joshua Juergen Julian Julien Julio Justin Karl Keith
Kenneth Kevin Kurt Kyle Larry Laurent Lawrence Leo Leon Leonard Leonardo Leroy Liam Logan Lorenzo Lucas Luca Luigi Luis Lukas Luke Manfred
Manuel Marc Marcel Marco Marcus Mario Markus Martin Mateo Matteo Matthew Matthias Maurice Max Maximilian Melvin Mohamed Mohammed
Muhammad Nathan Nathaniel Neil Nicholas Nicolas Niklas Noah Norbert Norman Oliver Olivier Omar Oscar Oskar Otto Owen Pablo Patrick Pedro
Philip Philippe Phillip Rafael Ralph Ramon Raul Raymond Reinhard Rene Ricardo Richard Roberto Rodrigo Roger Roland Ronald Ruben Rudolf
Russell Ryan Salvador Samuel Scott Sean Sebastian Sergio Seth Simon Stanley Stefan Stephan Stephen Steve Steven Stuart Sven Terry Theodore
Tim Timothy Tobias Todd Tom Tomas Tony Travis Trevor Tyler Uwe Victor Vincent Vincenzo Walter Warren Wayne Werner Wilhelm Wolfgang
Xavier Zachary Ahmed Ali Hassan Hussein Ibrahim Khalid Mustafa Yusuf Abdullah Arjun Rajesh Rahul Sanjay Vijay Amit Anil Suresh
Hiroshi Kenji Takashi Takeshi Jean
""".split(),
    ("cyrillic", "f"): """Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия Анастасия Дарья Ксения Виктория Людмила Галина
Марина Валентина Нина Оксана Полина София Алина Евгения Лариса Тамара""".split(),
    ("cyrillic", "m"): """Иван Сергей Александр Дмитрий Андрей Алексей Михаил Николай Владимир Виктор Юрий Павел Максим Игорь Олег Евгений
Константин Антон Денис Роман Артём Кирилл Василий Борис Григорий Пётр Степан Фёдор""".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Άννα Ειρήνη Κατερίνα Γεωργία Δήμητρα Ευαγγελία Αναστασία Ιωάννα Χριστίνα".split(),
    ("greek", "m"): "Γεώργιος Δημήτριος Κωνσταντίνος Ιωάννης Νικόλαος Χρήστος Γιώργος Νίκος Γιάννης Κώστας Δημήτρης Παναγιώτης Βασίλειος Αλέξανδρος Μιχάλης Πέτρος".split(),
}

# fixed values: words before and behind a given name that is part of a place's name
BEFORE_PLACES = """Lake Lac Lago Mount Mt St Saint Sainte San Santa Santo Sankt Fort Port Cape Point Loch Isle Port Rio Río Queen King
Hotel Villa Place Rue Via Calle Plaza Hurricane Storm""".split()
PLACES = frozenset("""Station Springs Street Avenue Boulevard Road Drive Square Beach Island Islands Falls County City Airport
University College Hospital Cathedral Hotel Museum Theatre Theater Stadium Tower Terrace Embankment Bridge River Lake Harbour
Harbor Peninsula Province Desert Bay Gardens Line Platz Straße Strasse Allee Bahnhof""".split())
# fixed values: verbs of speech behind a name
SPEECH = frozenset("""said says asked asks told tells replied replies answered answers wrote writes spoke speaks explained
explains added adds called calls thought thinks laughed smiled nodded sagte sagt fragte fragt antwortete dit demande dijo dice
disse сказал сказала говорит είπε λέει""".split())
